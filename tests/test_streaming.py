"""Streaming equals batch, restart from checkpoint, and the fold property."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_SUPP, HISTO_VALU
from flowdex.plans.analyzers import HistogramAnalyzer, SqlAnalyzer
from flowdex.session import work_dir
from flowdex.sinks.files import write_batch
from flowdex.streaming.histogram_state import HistogramState
from flowdex.streaming.runner import start_indexing, trigger_of


def _window_oracle(df):
    w = Window.partitionBy("v").orderBy("b").rangeBetween(Window.unboundedPreceding, 0)
    return {r["id"]: r["s"] for r in df.select("id", F.count(F.lit(1)).over(w).alias("s")).collect()}


@pytest.mark.parametrize("compact_every", [1, 2, 10])
def test_fold_property_random_batches(spark, compact_every):
    rng = random.Random(7)
    rows = [(i, rng.randrange(4), rng.choice("aaaabbc")) for i in range(300)]  # skewed values
    df = spark.createDataFrame(rows, "id int, b int, v string")
    msgs = df.select("id", "b", F.to_json(F.struct("v")).alias("value"))
    state = HistogramState(work_dir(spark, "fold"), "v", compact_every)
    got = {}
    for b in range(4):
        batch = msgs.where(F.col("b") == b).select("id", "value")
        out = state.enrich_batch(batch, b, keep=["id"])
        got.update({r["id"]: r[HISTO_SUPP] for r in out.collect()})
    assert got == _window_oracle(df)
    final = {r[HISTO_VALU]: r["n"] for r in state.load(spark, 3).collect()}
    assert final == {k: sum(1 for _, _, v in rows if v == k) for k in "abc"}


def test_state_storage_is_bounded(spark):
    """Slots are reused: however many batches, a level has at most twice as many runs as are merged at a time."""
    import glob
    import os
    base = work_dir(spark, "bounded")
    state = HistogramState(base, "v", compact_every=2)
    msgs = spark.createDataFrame([(1, '{"v":"x"}'), (2, '{"v":"y"}')], "id int, value string")
    for b in range(9):
        out = {r["id"]: r[HISTO_SUPP] for r in state.enrich_batch(msgs, b, keep=["id"]).collect()}
        assert out == {1: b + 1, 2: b + 1}
    local = base.replace("file:", "")
    slots = {p: len(glob.glob(f"{p}/slot=*")) for p in glob.glob(f"{local}/level=*")}
    assert {os.path.basename(p): n for p, n in slots.items()} == {"level=0": 4, "level=1": 2, "level=2": 1, "level=3": 1}


def test_runs_are_the_digits_of_the_batch_count():
    state = HistogramState("/nowhere", "v", compact_every=3)
    for n in range(200):
        runs = state.runs(n)
        covered = [b for level, start in runs for b in range(start, start + 3 ** level)]
        assert covered == list(range(n)) and len(runs) <= 2 * 5
        assert len({state.run_path(*r) for r in runs}) == len(runs)
    # Merging costs each batch's counts one rewrite a level.
    written = sum(3 ** max(i for i in range(9) if n % 3 ** i == 0) for n in range(1, 244) if n % 3 == 0)
    assert written <= 243 * 5


def test_a_batch_reads_only_the_parts_of_its_values(spark):
    """Files of other parts are made unreadable: a batch without their values doesn't notice."""
    import glob
    base = work_dir(spark, "pruned")
    state = HistogramState(base, "v", compact_every=3, parts=50)
    many = spark.range(400).select((F.col("id") % 200).cast("string").alias("v")).select(F.to_json(F.struct("v")).alias("value"))
    for b in range(4):
        state.enrich_batch(many, b).count()
    few = spark.createDataFrame([(f'{{"v":"{v}"}}',) for v in (3, 3, 77, 150)], "value string")
    wanted = {r[0] for r in spark.createDataFrame([("3",), ("77",), ("150",)], "v string").select(
        F.pmod(F.xxhash64("v"), F.lit(50))).collect()}
    spoilt = 0
    for path in glob.glob(f"{base.replace('file:', '')}/level=*/slot=*/part=*/*.parquet"):
        if int(path.split("part=")[1].split("/")[0]) not in wanted:
            with open(path, "wb") as f:
                f.write(b"no parquet")
            spoilt += 1
    assert spoilt > 60
    got = {r[HISTO_VALU]: r[HISTO_SUPP] for r in state.enrich_batch(few, 4).collect()}
    assert got == {"3": 10, "77": 9, "150": 9}
    plan = state.lookup(spark, 4, sorted(wanted))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan[plan.index("PartitionFilters: ["):]


def test_replayed_batch_is_idempotent(spark):
    msgs = spark.createDataFrame([(i, '{"v":"x"}') for i in range(5)], "id int, value string")
    state = HistogramState(work_dir(spark, "idem"), "v")
    state.enrich_batch(msgs, 0, keep=["id"]).collect()
    first = state.enrich_batch(msgs, 1, keep=["id"]).collect()
    again = state.enrich_batch(msgs, 1, keep=["id"]).collect()
    assert {r[HISTO_SUPP] for r in first} == {10} == {r[HISTO_SUPP] for r in again}


def test_empty_batch_carries_state(spark):
    state = HistogramState(work_dir(spark, "empty"), "v")
    msgs = spark.createDataFrame([(1, '{"v":"x"}')], "id int, value string")
    state.enrich_batch(msgs, 0).collect()
    assert state.enrich_batch(msgs.limit(0), 1).count() == 0
    assert {r[HISTO_VALU]: r["n"] for r in state.load(spark, 1).collect()} == {"x": 1}


def _write_batch(spark, feed, rows):
    spark.createDataFrame(rows, "value string").write.mode("append").text(feed)


def test_stream_restart_from_checkpoint(spark):
    base = work_dir(spark, "restart")
    feed, ckpt, out = f"{base}/feed", f"{base}/ckpt", f"{base}/out"
    analyzer = HistogramAnalyzer("v", f"{base}/state")

    def sink(df, batch_id):
        write_batch(df.select("value", HISTO_SUPP), out, batch_id)

    def run_once():
        src = spark.readStream.text(feed)
        start_indexing(src, analyzer, sink, ckpt, trigger=trigger_of(available_now=True)).awaitTermination()

    _write_batch(spark, feed, [('{"v":"a"}',), ('{"v":"b"}',)])
    run_once()  # batch 0, then the query stops
    _write_batch(spark, feed, [('{"v":"a"}',), ('{"w":"zz"}',)])
    run_once()  # resumed from the checkpoint: batch 1
    rows = spark.read.parquet(out).collect()
    by_batch = sorted((r["batch_id"], r["value"], r[HISTO_SUPP]) for r in rows)
    assert [b for b, _, _ in by_batch] == [0, 0, 1, 1]
    assert (1, '{"v":"a","histo_field":"v","histo_valu":"a","histo_supp":"2"}', 2) in by_batch
    assert (1, '{"w":"zz"}', None) in by_batch


def test_sql_analyzer_per_micro_batch(spark):
    base = work_dir(spark, "sqlstream")
    feed, ckpt, out = f"{base}/feed", f"{base}/ckpt", f"{base}/out"
    _write_batch(spark, feed, [('{"host":"a","path":"/var/log/system.log","lineno":80}',),
                               ('{"host":"a","path":"/var/log/system.log","lineno":90}',)])

    def sink(df, batch_id):
        df.write.mode("append").text(out)

    q = start_indexing(spark.readStream.text(feed), SqlAnalyzer(), sink, ckpt,
                       trigger=trigger_of(available_now=True))
    q.awaitTermination()
    assert [r["value"] for r in spark.read.text(out).collect()] == ['{"host":"a","count":2,"mean":85.0}']


def test_failed_batch_is_replayed_identically(spark):
    """A batch that dies after writing its state is re-run from the checkpoint with the same result."""
    from pyspark.errors import StreamingQueryException

    def run(base, fail_batch):
        feed, ckpt, out = f"{base}/feed", f"{base}/ckpt", f"{base}/out"
        analyzer = HistogramAnalyzer("v", f"{base}/state", compact_every=2)
        failed = []

        def sink(df, batch_id):
            write_batch(df.select("value", HISTO_SUPP), out, batch_id)
            if batch_id == fail_batch and not failed:
                failed.append(batch_id)
                raise RuntimeError("executor lost")

        def resume():
            q = start_indexing(spark.readStream.text(feed), analyzer, sink, ckpt,
                               trigger=trigger_of(available_now=True))
            try:
                q.awaitTermination()
            except StreamingQueryException:
                q = start_indexing(spark.readStream.text(feed), analyzer, sink, ckpt,
                                   trigger=trigger_of(available_now=True))
                q.awaitTermination()

        for rows in ([('{"v":"a"}',), ('{"v":"b"}',)], [('{"v":"a"}',)], [('{"v":"a"}',), ('{"v":"c"}',)]):
            _write_batch(spark, feed, rows)
            resume()
        return failed, sorted((r["batch_id"], r["value"], r[HISTO_SUPP]) for r in spark.read.parquet(out).collect())

    failed, with_failure = run(work_dir(spark, "fail"), fail_batch=1)
    _, clean = run(work_dir(spark, "clean"), fail_batch=-1)
    assert failed == [1]
    assert with_failure == clean
    assert (2, '{"v":"a","histo_field":"v","histo_valu":"a","histo_supp":"3"}', 3) in clean


def test_sql_analyzer_infers_schema_per_micro_batch(spark):
    base = work_dir(spark, "sqlinfer")
    feed, ckpt, out = f"{base}/feed", f"{base}/ckpt", f"{base}/out"
    statement = "SELECT path, COUNT(*) AS n, MAX(lineno) AS hi FROM logstash GROUP BY path"
    analyzer = SqlAnalyzer(statement=statement, schema=None, render=False)

    def sink(df, batch_id):
        write_batch(df, out, batch_id)

    def run_once():
        start_indexing(spark.readStream.text(feed), analyzer, sink, ckpt,
                       trigger=trigger_of(available_now=True)).awaitTermination()

    _write_batch(spark, feed, [('{"path":"/a","lineno":3}',), ('{"path":"/a","lineno":9}',), ("junk",)])
    run_once()
    _write_batch(spark, feed, [("not json",), ("[1,2]",)])  # nothing to infer: no report rows
    run_once()
    rows = sorted(((r["batch_id"], r["path"], r["n"], r["hi"]) for r in spark.read.parquet(out).collect()),
                  key=str)
    # "junk" is a record of NULL fields, grouped under a NULL path (as a per-batch JSON reader does).
    assert rows == [(0, "/a", 2, 9), (0, None, 1, None)]


def test_interaction_deletes_are_reported_in_stream_progress(spark):
    from flowdex.sources.feeds import open_interaction_feed
    base = work_dir(spark, "deletes")
    rows = [(False, '{"event_id":1,"event_type":"v","value":9.0}'),
            (True, '{"event_id":2,"event_type":"e","value":9.0}'),
            (True, '{"event_id":3,"event_type":"e","value":1.0}')]
    spark.createDataFrame(rows, "is_delete boolean, interaction string").write.parquet(f"{base}/in")
    q = (open_interaction_feed(spark, f"{base}/in").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    metrics = q.lastProgress["observedMetrics"]["interaction_feed"]
    assert metrics["deleted"] == 2
    assert spark.read.parquet(f"{base}/out").count() == 1


MSGS = [(1, '{"v":"x"}'), (2, '{"v":"y"}')]


def test_state_refuses_another_layout(spark):
    base = work_dir(spark, "layout")
    msgs = spark.createDataFrame(MSGS, "id int, value string")
    for b in range(3):
        HistogramState(base, "v", compact_every=2).enrich_batch(msgs, b).collect()
    with pytest.raises(ValueError, match="compact_every"):
        HistogramState(base, "v", compact_every=3).enrich_batch(msgs, 3)
    with pytest.raises(ValueError, match="field"):
        HistogramState(base, "w", compact_every=2).enrich_batch(msgs, 3)
    out = HistogramState(base, "v", compact_every=2).enrich_batch(msgs, 3).collect()
    assert {r[HISTO_SUPP] for r in out} == {4}


def test_state_refuses_gaps_and_new_checkpoints(spark):
    base = work_dir(spark, "gaps")
    msgs = spark.createDataFrame(MSGS, "id int, value string")
    state = HistogramState(base, "v")
    with pytest.raises(ValueError, match="no histogram state"):
        state.enrich_batch(msgs, 4)
    for b in range(3):
        state.enrich_batch(msgs, b).collect()
    for b in (0, 1, 4):  # a new checkpoint starts at 0 again; 4 would leave 3 out
        with pytest.raises(ValueError, match="ends with batch 2"):
            state.enrich_batch(msgs, b)
    assert state.load(spark, 3) is None and state.load(spark, 2).count() == 2


def test_documents_are_parsed_once_and_released(spark):
    state = HistogramState(work_dir(spark, "held"), "v")
    out = state.enrich_batch(spark.createDataFrame(MSGS, "id int, value string"), 0)
    assert state._held is not None and state._held.is_cached
    assert "InMemoryTableScan" in out._jdf.queryExecution().executedPlan().toString()
    state.release()
    assert state._held is None


def shouting(batch, batch_id):
    return batch.selectExpr("upper(value) as value", f"{batch_id} as b")


def test_any_analyzer_into_the_index(spark):
    from flowdex.operators.documents import doc_fields
    from flowdex.sinks.index import index_path, index_sink
    base = work_dir(spark, "anyindex")
    feed = f"{base}/feed"
    _write_batch(spark, feed, [('{"host":"a","path":"/var/log/system.log","lineno":80}',), ("no json",)])
    statement = "SELECT COUNT(*) AS n, MAX(host) AS top FROM logstash"
    seen = {}
    for name, analyzer in (("plain", None), ("custom", shouting), ("report", SqlAnalyzer()),
                           ("own", SqlAnalyzer(statement=statement)), ("histogram", HistogramAnalyzer("host", f"{base}/st"))):
        target = index_path(f"{base}/{name}", "logs", "message")
        start_indexing(spark.readStream.text(feed), analyzer, index_sink(target), f"{base}/{name}/ckpt",
                       trigger=trigger_of(available_now=True)).awaitTermination()
        docs = doc_fields(spark.read.parquet(target), ["host", "HOST", "count", "n", "top", "histo_supp"])
        seen[name] = sorted((tuple(r) for r in docs.collect()), key=str)
    empty = (None,) * 6
    assert seen == {"plain": sorted([("a", *empty[1:]), empty], key=str),
                    "custom": sorted([(None, "A", *empty[2:]), empty], key=str),
                    "report": [("a", None, "1", None, None, None)], "own": [(None, None, None, "2", "a", None)],
                    "histogram": sorted([("a", None, None, None, None, "1"), empty], key=str)}


@pytest.mark.parametrize("statement, bound", [
    ("SELECT host AS logstash FROM logstash", "SELECT host AS logstash FROM {logstash} AS logstash"),
    ("SELECT logstash.host FROM logstash WHERE 1=1", "SELECT logstash.host FROM {logstash} AS logstash WHERE 1=1"),
    ("select l.host from `logstash` l join logstash as m on l.host = m.host",
     "select l.host from {logstash} l join {logstash} as m on l.host = m.host"),
    ("SELECT 'from logstash' x FROM LOGSTASH", "SELECT 'from logstash' x FROM {logstash} AS logstash"),
    ("SELECT * FROM t, logstash", None), ("SELECT 1 -- FROM logstash", None), ("SELECT 1", None)])
def test_view_binding(statement, bound):
    from flowdex.operators.sqlreport import bind_view
    assert bind_view(statement, "logstash") == bound


def test_aliases_of_the_views_name_keep_it(spark):
    from flowdex.operators.sqlreport import sql_analyzer
    msgs = spark.createDataFrame([('{"host":"a","path":"p","lineno":1}',)], "value string")
    for statement in ("SELECT host AS logstash FROM logstash", "SELECT logstash.host AS logstash FROM logstash",
                      "SELECT max(b.host) AS logstash FROM (SELECT 1 AS x) a, logstash b"):
        out = sql_analyzer(msgs, statement)
        assert out.columns == ["logstash"] and [tuple(r) for r in out.collect()] == [("a",)]
