"""Feed -> analyzer -> sink as one Structured Streaming query.

Sorting, limits and the non-time windows the analyzers need are not allowed on
a streaming DataFrame, so the analyzer runs inside ``foreachBatch`` on each
micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowdex.plans.analyzers import Analyzer, apply_analyzer

Sink = Callable[[DataFrame, int], None]


BATCH_DURATION_CONF = "spark.batch.duration"


def trigger_of(batch_seconds: float | None = None, available_now: bool = False,
               spark: SparkSession | None = None) -> dict:
    """Micro-batch interval in seconds -> a processing-time trigger; tests use available-now.

    Without ``batch_seconds`` the interval is read from the session's
    ``spark.batch.duration`` setting (5 seconds when that is unset too).
    """
    if available_now:
        return {"availableNow": True}
    if batch_seconds is None and spark is not None:
        configured = spark.conf.get(BATCH_DURATION_CONF, None)
        batch_seconds = float(configured) if configured else None
    return {"processingTime": f"{5 if batch_seconds is None else batch_seconds} seconds"}


def run_micro_batch(batch: DataFrame, batch_id: int, analyzer: Analyzer | None, sink: Sink) -> None:
    """Analyze one micro-batch and write it.

    The batch is persisted only for an analyzer that says it scans it more than
    once (``rereads_batch``; a plain function is taken to): a batch that is read
    once isn't copied to the executors' disks.
    """
    persist = analyzer is not None and getattr(analyzer, "rereads_batch", True)
    if persist:
        batch.persist()
    try:
        out = apply_analyzer(batch, analyzer, batch_id)
        if out is not None:  # an analyzer may have nothing to emit for this batch
            sink(out, batch_id)
    finally:
        if persist:
            batch.unpersist()
        release = getattr(analyzer, "release", None)
        if release:
            release()


def start_indexing(source: DataFrame, analyzer: Analyzer | None, sink: Sink, checkpoint: str,
                   trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the query and return its handle; the caller decides how to wait.

    Recovery after a failure is Spark's: the checkpoint holds source offsets and
    the last committed batch id, the analyzer's state and the sink are keyed by
    batch id, so the interrupted batch is recomputed and overwritten.
    """
    writer = (source.writeStream
              .foreachBatch(lambda df, bid: run_micro_batch(df, bid, analyzer, sink))
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or trigger_of()))
              )
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
