"""Registered queries that run the streaming forms end to end.

Each one stages its input under the session's checkpoint folder, replays the
table as a feed (one micro-batch per day where the oracle needs it) to one
running Structured Streaming query and returns the sink's contents as a
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_SUPP, HISTO_VALU
from flowdex.operators import sqlreport
from flowdex.operators.documents import doc_fields, prepare_documents
from flowdex.plans.analyzers import HistogramAnalyzer, SqlAnalyzer
from flowdex.plans.catalog import L, RUNNING, MAIL_PARTS, mail_parts, register
from flowdex.session import work_dir
from flowdex.sinks.files import batch_sink, write_batch
from flowdex.sinks.index import index_path, index_sink, read_index, write_index
from flowdex.sources import feeds, mail, mailbox, shards, tables
from flowdex.streaming import replay
from flowdex.streaming.quarantine import quarantine
from flowdex.streaming.schema_state import SchemaState, column_profile
from flowdex.streaming.runner import run_micro_batch, start_indexing, trigger_of

SHARDS = 4


@register("shard_union", """
select event_id, event_type from events""")
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SHARDS`` independent shard sources (by a hash of the id) unioned into one feed."""
    return feeds.union_shards(tables.shard_sources(spark, sf_dir, "events", ["event_id", "event_type"], SHARDS))


SHARD_PARENTS = {"a": [], "b": [], "a0": ["a"], "a2": ["a"], "m": ["a2", "b"]}


@register("shard_lineage", """
with e as (select event_id, event_type, date_diff('day', min(cast(ts as date)) over (), cast(ts as date)) as d from events),
s as (select *, case when d < 10 then case when event_id % 2 = 0 then 'a' else 'b' end
                     when event_id % 4 = 0 then 'a0' when d < 20 then case when event_id % 4 = 2 then 'a2' else 'b' end
                     else 'm' end as shard from e)
select event_id, event_type, shard, case shard when 'a' then 0 when 'b' then 0 when 'm' then 2 else 1 end as generation,
       false as early from s""")
def shard_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards split and merge under one stream, restarts between; ``early``: in a batch before one of a parent's last."""
    base = work_dir(spark, "shard_lineage")
    root, out = f"{base}/shards", f"{base}/out"
    phased = f"{base}/phased"
    tables.resharded(tables.table(spark, sf_dir, "events")).write.partitionBy("phase", "shard").parquet(phased)
    records = spark.read.schema("event_id long, event_type string, phase int, shard string").parquet(phased)
    sink = batch_sink(out)

    def run():
        query = start_indexing(shards.read_shards(spark, root, "event_id long, event_type string"), None, sink,
                               f"{base}/checkpoint", trigger=trigger_of(0))
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    def arrive(phase: int, *names: str):
        for name in names:
            rows = records.where((F.col("phase") == phase) & (F.col("shard") == name))
            shards.append_segment(rows.select("event_id", "event_type"), root, name)

    def add(*names: str):
        for name in names:
            shards.add_shard(spark, root, name, SHARD_PARENTS[name])

    add("a", "b")
    arrive(0, "a", "b")
    run()
    add("a0", "a2", "m")  # parents are open: nothing of these may come yet
    arrive(1, "a0", "a2", "b")
    arrive(2, "m")
    run()
    shards.close_shard(spark, root, "a")
    shards.close_shard(spark, root, "b")
    run()
    shards.close_shard(spark, root, "a2")
    arrive(2, "a0")
    run()
    got = spark.read.parquet(out).select("event_id", "event_type", "shard", "generation", F.col("batch_id").cast("bigint").alias("b"))
    lineage = spark.createDataFrame([(s, p) for s, ps in SHARD_PARENTS.items() for p in ps], "shard string, parent string")
    last = got.groupBy(F.col("shard").alias("parent")).agg(F.max("b").alias("last")).join(lineage, "parent")
    last = last.groupBy("shard").agg(F.max("last").alias("last"))
    return got.join(last, "shard", "left").select("event_id", "event_type", "shard", "generation",
                                                  F.coalesce(F.col("b") < F.col("last"), F.lit(False)).alias("early"))


@register("index_write", L + """
select event_id, host, path, cast(lineno as varchar) lineno from L""")
def index_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> K2/K3: documents written to the index directory and read back."""
    target = index_path(work_dir(spark, "index"), "logs", "message")
    docs = prepare_documents(tables.log_messages(tables.table(spark, sf_dir, "events")), keep=["event_id"])
    write_index(docs.limit(1), target, batch_id=0, id_col="event_id")  # an attempt that the next one replaces
    write_index(docs, target, batch_id=0, id_col="event_id")
    return doc_fields(read_index(spark, target), ["host", "path", "lineno"], keep=["event_id"])


def _replayed_stream(spark, msgs: DataFrame, columns, fmt: str, source_of, analyzer, sink, base: str):
    staged, days = replay.stage(msgs, "batch", f"{base}/staged")
    feed_dir, ckpt = f"{base}/feed", f"{base}/checkpoint"

    def start():
        return start_indexing(source_of(replay.arrivals(feed_dir)), analyzer, sink, ckpt, trigger=trigger_of(0))

    replay.replay(staged, "batch", days, feed_dir, columns, fmt, start)


@register("histogram_stream", L + f"""
select event_id, host as histo_valu, {RUNNING} as histo_supp from L""")
def histogram_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 streaming: one micro-batch per day, state versioned by batch id."""
    base = work_dir(spark, "histogram_stream")
    out = f"{base}/out"
    msgs = tables.log_messages(tables.table(spark, sf_dir, "events"))
    analyzer = HistogramAnalyzer("host", f"{base}/state", keep=["event_id"])

    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df.select("event_id", HISTO_VALU, HISTO_SUPP), out, batch_id)

    source = lambda d: spark.readStream.schema("event_id bigint, value string").parquet(d)
    _replayed_stream(spark, msgs, ["event_id", "value"], "parquet", source, analyzer, sink, base)
    return spark.read.parquet(out).select("event_id", HISTO_VALU, HISTO_SUPP)


@register("feed_to_index", L + f"""
select event_id, host as histo_valu, {RUNNING} as histo_supp from L""")
def feed_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text feed -> histogram analyzer -> index sink, all in one streaming query.

    The feed carries only text lines; the event id travels inside the JSON.
    """
    base = work_dir(spark, "feed_to_index")
    target = index_path(base, "logs", "message")
    msgs = tables.log_messages(tables.table(spark, sf_dir, "events"), with_id_in_text=True)
    analyzer = HistogramAnalyzer("host", f"{base}/state")
    source = lambda d: feeds.read_text_feed(spark, d)
    _replayed_stream(spark, msgs, ["value"], "text", source, analyzer, index_sink(target), base)
    docs = doc_fields(read_index(spark, target), ["event_id", HISTO_VALU, HISTO_SUPP])
    return docs.select(F.col("event_id").cast("bigint"), HISTO_VALU, F.col(HISTO_SUPP).cast("bigint"))


@register("log_report_stream", L + """
select dense_rank() over (order by batch) - 1 as batch_id, host, count(host) host_c,
       round(avg(lineno),4) line_a
from L where path='/var/log/system.log' and lineno>70 group by batch, host
qualify row_number() over (partition by batch order by count(host) desc, host) <= 100""")
def log_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 streaming: the default SQL report on every micro-batch (one per day)."""
    base = work_dir(spark, "log_report_stream")
    out = f"{base}/out"
    msgs = tables.log_messages(tables.table(spark, sf_dir, "events"))
    analyzer = SqlAnalyzer(render=False)

    sink = batch_sink(out)

    source = lambda d: feeds.read_text_feed(spark, d)
    _replayed_stream(spark, msgs, ["value"], "text", source, analyzer, sink, base)
    report = spark.read.parquet(out)
    return report.select(F.col("batch_id").cast("bigint"), "host", "host_c", F.round("line_a", 4).alias("line_a"))


@register("feed_to_index_plain", L + """
select dense_rank() over (order by batch) - 1 as batch_id, event_id, host, path, cast(lineno as varchar) lineno
from L""")
def feed_to_index_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + K1/K2/X7: text feed -> no analyzer -> index sink, which prepares the documents."""
    base = work_dir(spark, "feed_to_index_plain")
    target = index_path(base, "logs", "message")
    msgs = tables.log_messages(tables.table(spark, sf_dir, "events"), with_id_in_text=True)
    source = lambda d: feeds.read_text_feed(spark, d)
    _replayed_stream(spark, msgs, ["value"], "text", source, None, index_sink(target), base)
    docs = doc_fields(read_index(spark, target), ["event_id", "host", "path", "lineno"], keep=["batch_id"])
    return docs.select(F.col("batch_id").cast("bigint"), F.col("event_id").cast("bigint"), "host", "path", "lineno")


@register("report_to_index", L + """
select dense_rank() over (order by batch) - 1 as batch_id, host, cast(count(host) as varchar) "count",
       round(avg(lineno),4) mean
from L where path='/var/log/system.log' and lineno>70 group by batch, host
qualify row_number() over (partition by batch order by count(host) desc, host) <= 100""")
def report_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 + K1/K2/X7: text feed -> SQL report -> index sink, report rows as flat documents."""
    base = work_dir(spark, "report_to_index")
    target = index_path(base, "logs", "report")
    msgs = tables.log_messages(tables.table(spark, sf_dir, "events"))
    source = lambda d: feeds.read_text_feed(spark, d)
    _replayed_stream(spark, msgs, ["value"], "text", source, SqlAnalyzer(), index_sink(target), base)
    docs = doc_fields(read_index(spark, target), ["host", "count", "mean"], keep=["batch_id"])
    return docs.select(F.col("batch_id").cast("bigint"), "host", "count", F.round(F.col("mean").cast("double"), 4).alias("mean"))


@register("schema_by_batch", """
with e as (select *, date_diff('day', min(cast(ts as date)) over (), cast(ts as date)) as d from events
           where event_type is not null and (props->>'$.k') is not null),
b as (select d, dense_rank() over (order by d) - 1 as batch_id, count(*) n, count(*) filter (event_id % 10 = 0) tenth
      from e group by d),
r as (select *, max(case when d >= 10 and d % 2 = 0 then case when d >= 18 and d % 6 = 0 then 3 when d >= 14 then 2 else 1 end
                    else 0 end) over upto as score,
             max(case when d >= 24 and d % 6 = 0 then 1 else 0 end) over upto as text,
             max(case when d >= 20 and tenth > 0 then 1 else 0 end) over upto as zone
      from b window upto as (order by d rows unbounded preceding))
select batch_id, 'host' as "column", 'string' as kind, n from r
union all select batch_id, 'lineno', case text when 1 then 'string' else 'long' end, n from r
union all select batch_id, 'score', case score when 1 then 'long' when 2 then 'decimal' else 'double' end,
                 case when d % 2 = 0 then n else 0 end from r where score > 0
union all select batch_id, 'zone', 'struct', case when d >= 20 then tenth else 0 end from r where zone > 0""")
def schema_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 across batches: every column known after each batch (one per day), its type so far and the records that have it."""
    base = work_dir(spark, "schema_by_batch")
    msgs = tables.drifting_messages(tables.table(spark, sf_dir, "events"))
    state = SchemaState(f"{base}/schema")

    def profile(batch: DataFrame, batch_id: int) -> DataFrame | None:
        schema = state.advance(batch)
        return schema and column_profile(sqlreport.parse_records(batch, schema), schema)

    source = lambda d: feeds.read_text_feed(spark, d)
    _replayed_stream(spark, msgs, ["value"], "text", source, profile, batch_sink(f"{base}/out"), base)
    return spark.read.parquet(f"{base}/out").select(F.col("batch_id").cast("bigint"), "column", "kind", "n")


@register("mail_stream", MAIL_PARTS)
def mail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S15 + S18: a mail drop folder streamed, parsed, written out."""
    base = work_dir(spark, "mail_stream")
    drop, out = f"{base}/drop", f"{base}/out"
    raw = tables.raw_mail(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "pages"))
    raw.write.parquet(drop)
    parts = mail_parts(mail.flatten_mail(mail.read_mail_drop(spark, drop)))
    query = (parts.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return spark.read.parquet(out)


def _quarantined(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A drop with ordinary bad mail streamed into two sinks, ``good`` and ``rejects`` under the folder that is returned."""
    base = work_dir(spark, name)
    tables.odd_mail(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "pages")).write.parquet(f"{base}/drop")
    sink = quarantine(batch_sink(f"{base}/good"), batch_sink(f"{base}/rejects"))
    query = (mail.check_mail(mail.read_mail_drop(spark, f"{base}/drop")).writeStream
             .foreachBatch(lambda df, batch_id: run_micro_batch(df, batch_id, None, sink))
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return base


@register("mail_rejects", f"""
select doc_id as msg_no, source as folder, case doc_id % 20 when 3 then '{mail.NULL_MESSAGE}' else '{mail.BROKEN_MULTIPART}' end as error,
       case doc_id % 20 when 8 then octet_length(encode('From: a@feed.example' || chr(13) || chr(10)
         || 'Content-Type: multipart/mixed; boundary=gone' || chr(13) || chr(10) || chr(13) || chr(10) || 'no part ' || doc_id)) end as n_bytes
from documents where doc_id % 20 in (3, 8)""")
def mail_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that can't be read, with the reason and their bytes, beside a stream that goes on."""
    rejects = spark.read.parquet(f"{_quarantined(spark, sf_dir, 'mail_rejects')}/rejects")
    return rejects.select("msg_no", "folder", "error", F.octet_length("raw").cast("bigint").alias("n_bytes"))


@register("mail_accepted", f"""
with d as (select *, doc_id % 20 as kind from documents)
select doc_id as msg_no,
       case kind when 13 then 'Jörg <jorg@feed.example>' when 1 then 'Jörg <jörg@feed.example>' when 18 then 'a@feed.example'
            else case when doc_id % 3 = 0 then 'Feed ' || source || ' <' || source || '@feed.example>'
                      else source || '@feed.example' end end as sender,
       case kind when 13 then 'Größe ' || doc_id when 1 then 'Größe ' || doc_id when 18 then '=?utf-8?B?abcde?= ' || doc_id
            else case when doc_id % 4 = 0 then 'Größe ' || doc_id else 'document ' || doc_id end end as subject,
       md5(case when kind in (1, 13, 18) then 'body ' || doc_id else text end) as body_md5
from d where kind not in (3, 8)""")
def mail_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 + S17/S18: what goes on of the same stream, 8-bit and undecodable headers included."""
    good = spark.read.parquet(f"{_quarantined(spark, sf_dir, 'mail_accepted')}/good")
    return good.select("msg_no", F.col("from").alias("sender"), "subject", F.md5(F.col("content")[0]["content"]).alias("body_md5"))


POLL = 2000


@register("mail_polls", f"""
select p as poll, least({POLL}, n - p * {POLL})::bigint as messages
from (select n, unnest(range((n + {POLL - 1}) // {POLL})) p from (select count(*) n from documents))""")
def mail_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop polled by messages, whatever files they came in; every message in one poll."""
    base = work_dir(spark, "mail_polls")
    raw = tables.raw_mail(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "pages"))
    raw.write.option("parquet.block.size", str(4 << 20)).parquet(f"{base}/drop")  # a poll takes few row groups
    polls = mailbox.read_mail_polls(spark, f"{base}/drop", f"{base}/progress", per_poll=POLL, per_partition=250)
    sink = batch_sink(f"{base}/out")
    query = (polls.writeStream.foreachBatch(lambda df, batch_id: sink(df.select("msg_no"), batch_id))
             .option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="0 seconds").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return (spark.read.parquet(f"{base}/out").groupBy(F.col("batch_id").cast("bigint").alias("poll"))
            .agg(F.countDistinct("msg_no").alias("messages")))
