"""Kafka output: record building and sink options (connector jar needed for I/O)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.functions.text import encode_utf8

# The producer's retry count; acks are "all replicas", as the
# reference intended (its misspelled property never applied it).
PRODUCER_RETRIES = 3
PRODUCER_ACKS = "all"
PRODUCER_COMPRESSION = "gzip"


def records(df: DataFrame, value_col: str, key_col: str | None = None,
            topic_col: str | None = None, topic: str | None = None) -> DataFrame:
    """``key BINARY`` (nullable), ``value BINARY``, ``topic STRING`` rows for the Kafka sink."""
    types = dict(df.dtypes)
    if not key_col:
        key = F.lit(None).cast("binary")
    elif types[key_col] == "binary":
        key = F.col(key_col)  # bytes stay as they are: they needn't be text
    else:
        key = encode_utf8(F.col(key_col).cast("string"))
    if topic_col:
        topic_expr = F.col(topic_col)
    elif topic:
        topic_expr = F.lit(topic)
    else:
        raise ValueError("give topic_col or topic")
    value = F.col(value_col)
    if types[value_col] != "binary":
        value = encode_utf8(value)
    return df.select(key.alias("key"), value.alias("value"), topic_expr.alias("topic"))


def sink_options(brokers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options; brokers must be given (no localhost default)."""
    if not brokers:
        raise ValueError("brokers are required")
    opts = {
        "kafka.bootstrap.servers": brokers,
        "kafka.acks": PRODUCER_ACKS,
        "kafka.retries": str(PRODUCER_RETRIES),
        "kafka.compression.type": PRODUCER_COMPRESSION,
    }
    if topic:
        opts["topic"] = topic
    return opts


def write(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("kafka").options(**options).save()
