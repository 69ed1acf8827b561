"""Readers of an index directory see a batch's old attempt or its new one, never neither and never both."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_VALU
from flowdex.operators import histogram
from flowdex.plans.analyzers import TopKAnalyzer
from flowdex.session import work_dir
from flowdex.sinks import commit_log, index


def test_rewrites_replace_and_old_readers_finish(spark):
    root = work_dir(spark, "commits")
    commit_log.write_committed(spark.range(3), root, 0)
    commit_log.write_committed(spark.range(10, 12), root, 1)
    early = commit_log.read_committed(spark, root)
    commit_log.write_committed(spark.range(5, 7), root, 0)
    assert sorted(map(tuple, early.collect())) == [(0, 0), (1, 0), (2, 0), (10, 1), (11, 1)]
    now = commit_log.read_committed(spark, root)
    assert now.columns == ["id", "batch_id"] and sorted(map(tuple, now.collect())) == [(5, 0), (6, 0), (10, 1), (11, 1)]
    assert commit_log.vacuum(spark, root) == [] and len(commit_log.vacuum(spark, root, older_seconds=-5)) == 2  # the attempt and its entry
    assert sorted(map(tuple, commit_log.read_committed(spark, root).collect())) == sorted(map(tuple, now.collect()))


def test_a_failed_attempt_is_never_seen(spark):
    root = work_dir(spark, "failed")
    commit_log.write_committed(spark.range(3), root, 0)
    bad = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        commit_log.write_committed(bad, root, 0)
    assert commit_log.read_committed(spark, root).count() == 3


def test_readers_during_rewrites(spark):
    root = work_dir(spark, "race")
    commit_log.write_committed(spark.range(4), root, 0)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(tuple(sorted(r.id for r in commit_log.read_committed(spark, root).collect())))

    thread = threading.Thread(target=read)
    thread.start()
    for i in range(1, 9):
        commit_log.write_committed(spark.range(i * 10, i * 10 + 4), root, 0)
    stop.set()
    thread.join()
    whole = {tuple(range(i * 10, i * 10 + 4)) for i in range(9)}
    assert len(seen) > 2 and set(seen) <= whole


def test_empty_directory(spark):
    root = work_dir(spark, "none")
    with pytest.raises(ValueError):
        commit_log.read_committed(spark, root)
    assert index.read_index(spark, root, schema="id long").collect() == []


def brute(rows, k):
    out, counts = {}, {}
    for b in sorted({b for b, _ in rows}):
        for x, v in rows:
            if x == b:
                counts[v] = counts.get(v, 0) + 1
        out[b] = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
    return out


@pytest.mark.parametrize("batches, values, k", [(1, 4, 3), (23, 9, 3), (23, 400, 5), (40, 2, 4)])
def test_running_top_k(spark, batches, values, k):
    rng = random.Random(batches * values)
    rows = [(rng.randrange(batches) * 2, f"v{min(rng.randrange(values), rng.randrange(values)):03d}") for _ in range(600)]
    rows += [(0, "early")] * 30
    df = spark.createDataFrame(rows, f"batch int, {HISTO_VALU} string")
    running = histogram.running_support(histogram.field_support_by_batch(df))
    got = {}
    for r in histogram.running_top_k(running, k).collect():
        got.setdefault(r.batch, {})[r["rank"]] = (r[HISTO_VALU], r.n)
    assert {b: [x[i + 1] for i in range(len(x))] for b, x in got.items()} == brute(rows, k)
    assert histogram.running_top_k(running.limit(0), k).collect() == histogram.running_top_k(running, 0).collect() == []


def test_top_k_of_a_stream_keeps_absent_values(spark):
    import json
    analyzer = TopKAnalyzer("v", work_dir(spark, "topk"), 2, compact_every=2)
    batches = [list("aaabb"), list("c"), list("cccc"), list("bbx"), list("x")]
    rows = []
    for i, values in enumerate(batches):
        rows += [(i, v) for v in values]
        batch = spark.createDataFrame([(f'{{"v":"{v}"}}',) for v in values], "value string")
        for _ in range(2):  # every batch is run again
            got = sorted((json.loads(r.value) for r in analyzer(batch, i).collect()), key=lambda r: r["rank"])
        assert [(r["histo_valu"], r["n"]) for r in got] == brute(rows, 2)[i]
