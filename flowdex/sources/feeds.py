"""Message feeds: every feed is normalised to rows with one text column ``value``.

A feed is either a streaming DataFrame (``readStream``) or a plain table with
the same columns, so every operator below works on both.  Broker-backed feeds
(Kafka) only build options here; the connector jar must be on the classpath to
actually read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowdex.functions.text import decode_utf8


# ---------------------------------------------------------------- Kafka

def parse_topic_list(spec: str | Sequence[str]) -> list[str]:
    """``"a, b,,c"`` -> ``["a", "b", "c"]`` (split on commas, trim, drop blanks)."""
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    return [t.strip() for t in items if t and t.strip()]


def whitelist_regex(pattern: str) -> str:
    """A topic whitelist as a whole-name regex; commas act as alternation."""
    alternatives = [p.strip() for p in pattern.split(",") if p.strip()]
    return "^(?:" + "|".join(alternatives) + ")$"


def kafka_source_options(bootstrap_servers: str, topics: str | Sequence[str] | None = None,
                         pattern: str | None = None, group: str | None = None,
                         timeout_ms: int | None = None, from_start: bool = True,
                         min_partitions: int | None = None,
                         max_offsets: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``max_offsets`` bounds the records of a micro-batch, so that a backlog is
    worked off in batches instead of as one.

    ``group``/``timeout_ms`` map to the consumer group and poll timeout; the
    per-topic thread count of a receiver has no meaning for Spark's Kafka
    source and is expressed as ``minPartitions`` instead.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give exactly one of topics / pattern")
    opts = {"kafka.bootstrap.servers": bootstrap_servers,
            "startingOffsets": "earliest" if from_start else "latest"}
    if topics is not None:
        opts["subscribe"] = ",".join(parse_topic_list(topics))
    else:
        opts["subscribePattern"] = whitelist_regex(pattern)[1:-1]
    if group:
        opts["kafka.group.id"] = group
    if timeout_ms is not None:
        opts["kafkaConsumer.pollTimeoutMs"] = str(int(timeout_ms))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def record_id(topic_col: str = "topic", partition_col: str = "partition",
              offset_col: str = "offset") -> Column:
    """A document id from the record's broker position: ``topic:partition:offset``.

    Identical messages get different ids, and a replayed record the same id, so
    an index written with it is exactly-once under replays.
    """
    return F.concat_ws(":", F.col(topic_col), F.col(partition_col).cast("string"),
                       F.col(offset_col).cast("string"))


def subscribe_topics(records: DataFrame, topics: str | Sequence[str],
                     topic_col: str = "topic") -> DataFrame:
    """Keep records of the listed topics (what ``subscribe`` does at the broker)."""
    return records.where(F.col(topic_col).isin(parse_topic_list(topics)))


def subscribe_pattern(records: DataFrame, pattern: str, topic_col: str = "topic") -> DataFrame:
    """Keep records whose whole topic name matches the whitelist."""
    return records.where(F.col(topic_col).rlike(whitelist_regex(pattern)))


def subscribe_prefix(records: DataFrame, prefix: str, topic_col: str = "topic") -> DataFrame:
    """Prefix subscription on the topic (frame 0); an empty prefix keeps all."""
    if not prefix:
        return records
    return records.where(F.col(topic_col).startswith(prefix))


def record_values(records: DataFrame, value_col: str = "value",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Drop the record key: keep the value, decoded to text."""
    return records.select(*keep, decode_utf8(value_col).alias("value"))


# --------------------------------------------------------- shards, frames

def union_shards(shards: Sequence[DataFrame]) -> DataFrame:
    """Bag union of independent shard feeds (duplicates kept); works on streams."""
    if not shards:
        raise ValueError("no shards")
    return reduce(lambda a, b: a.unionByName(b), shards)


def flatten_frames(messages: DataFrame, frames_col: str = "frames",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Every frame of a multi-frame message becomes one text message.

    ``pos`` keeps the frame position so the original order is recoverable.
    """
    return (messages
            .select(*keep, F.posexplode(frames_col).alias("pos", "_frame"))
            .select(*keep, F.col("pos").cast("bigint").alias("pos"),
                    decode_utf8("_frame").alias("value")))


def topic_frame(frames_col: str = "frames") -> Column:
    """Frame 0 of a multi-frame message, as text (the topic, where one is used)."""
    return decode_utf8(F.col(frames_col).getItem(0))


# ------------------------------------------------- interaction feed

INTERACTION_SCHEMA = "event_id bigint, event_type string, value double"


def interaction_feed(interactions: DataFrame, query: str | None = None,
                     schema: str = INTERACTION_SCHEMA, delete_col: str = "is_delete",
                     value_col: str = "interaction", keep: Sequence[str] = (),
                     observation: Observation | str = "interaction_feed") -> DataFrame:
    """Interactions -> JSON text messages.

    Delete events never enter the stream; their number is the ``deleted``
    metric of ``observation`` (an ``Observation`` on tables, a metric name
    reported to query listeners on streams).  ``query`` replaces the vendor's
    server-side filter: a Spark SQL predicate over the interaction's fields.
    """
    flagged = interactions.observe(observation,
                                   F.sum(F.col(delete_col).cast("long")).alias("deleted"))
    live = flagged.where(~F.coalesce(F.col(delete_col), F.lit(False)))
    # Passthrough columns and the message are parked under private names so the
    # predicate can use the interaction's own field names unqualified.
    # Parsed once inside a one-row explode, so the predicate cannot be pushed below
    # the parse and re-run ``from_json`` (see sqlreport.parse_once).
    staged = live.select(*[F.col(k).alias(f"__keep_{k}") for k in keep],
                         F.col(value_col).alias("__message"),
                         F.explode(F.array(F.from_json(value_col, schema))).alias("__i")
                         ).select("*", "__i.*")
    if query:
        staged = staged.where(F.expr(query))
    return staged.select(*[F.col(f"__keep_{k}").alias(k) for k in keep],
                         F.col("__message").alias("value"))


# The three status levels and the text that follows the level.
STATUS_ERROR = "Error"
STATUS_INFO = "Info"
STATUS_WARNING = "Warning"
STATUS_SEPARATOR = ":\n"


def status_messages(status: DataFrame, is_error: str = "is_error", is_info: str = "is_info",
                    message_col: str = "message", keep: Sequence[str] = ()) -> DataFrame:
    """Classify vendor status messages into ``Error``/``Info``/``Warning`` text.

    The reference only logs these; here they are a side-output table.
    """
    level = (F.when(F.col(is_error), F.lit(STATUS_ERROR))
             .when(F.col(is_info), F.lit(STATUS_INFO))
             .otherwise(F.lit(STATUS_WARNING)))
    return status.select(*keep, F.concat(level, F.lit(STATUS_SEPARATOR),
                                         F.coalesce(F.col(message_col), F.lit(""))).alias("message"))


def _reader(spark: SparkSession, streaming: bool, files_per_trigger: int | None):
    """A stream or batch reader; ``files_per_trigger`` bounds the files of a micro-batch."""
    if not streaming:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", str(files_per_trigger)) if files_per_trigger else reader


def read_text_feed(spark: SparkSession, path: str, streaming: bool = True,
                   files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines / text files as a feed of messages (one line = one message)."""
    return _reader(spark, streaming, files_per_trigger).text(path)


# --------------------------------------------- feed openers (source -> value stream)

def open_kafka_feed(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Kafka records -> text messages (key dropped) with ``record_id``, the id a replay repeats."""
    records = read_kafka(spark, options, streaming)
    return identified_values(records)


def identified_values(records: DataFrame) -> DataFrame:
    """``record_id, value`` of broker records: write an index by ``record_id`` and a replayed batch replaces itself."""
    return record_values(records.withColumn("record_id", record_id()), keep=["record_id"])


def open_shard_feed(spark: SparkSession, shard_paths: Sequence[str], fmt: str = "parquet",
                    schema: str = "value binary", value_col: str = "value",
                    streaming: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """One source per shard folder, unioned, bytes decoded as UTF-8 text."""
    shards = [_reader(spark, streaming, files_per_trigger).schema(schema).format(fmt).load(p) for p in shard_paths]
    return record_values(union_shards(shards), value_col)


def open_frame_feed(spark: SparkSession, path: str, topic: str = "", fmt: str = "parquet",
                    schema: str = "frames array<binary>", frames_col: str = "frames",
                    streaming: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """Multi-frame messages subscribed by topic prefix (frame 0), every frame one message."""
    messages = _reader(spark, streaming, files_per_trigger).schema(schema).format(fmt).load(path)
    subscribed = subscribe_prefix(messages.withColumn("__topic", topic_frame(frames_col)), topic, "__topic")
    return flatten_frames(subscribed.drop("__topic"), frames_col)


def open_interaction_feed(spark: SparkSession, path: str, query: str | None = None,
                          fmt: str = "parquet",
                          schema: str = "is_delete boolean, interaction string",
                          streaming: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """Interaction rows -> JSON messages, deletes dropped, ``query`` applied."""
    return interaction_feed(_reader(spark, streaming, files_per_trigger).schema(schema).format(fmt).load(path), query=query)
