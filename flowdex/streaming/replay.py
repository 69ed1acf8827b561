"""Replay a table as a feed: one arrival per value of its batch column, one running query.

The table is staged once, partitioned by the batch column.  Each batch value is
then written by as many tasks as its staged files take into a hidden folder beside
the feed's, which gets its place by one rename, so the running query sees an
arrival whole and makes it exactly one micro-batch.  This
is a harness for tests and registered queries: a real feed's files come as they
come.  The driver only orders the batch values; rows never pass through it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stage(df: DataFrame, batch_col: str, folder: str) -> tuple[DataFrame, list]:
    """Write ``df`` partitioned by ``batch_col``; return the staged table and its batch values in order."""
    df.write.mode("overwrite").partitionBy(batch_col).parquet(folder)
    staged = df.sparkSession.read.parquet(folder)
    values = [r[0] for r in staged.select(batch_col).distinct().orderBy(batch_col).collect()]
    return staged, values


def arrivals(feed_dir: str) -> str:
    """The path that a streaming reader of a replayed feed takes."""
    return f"{feed_dir}/arrival-*"


def replay(staged: DataFrame, batch_col: str, values: Sequence, feed_dir: str,
           columns: Sequence[str], fmt: str, start: Callable[[], StreamingQuery]) -> None:
    """Add each batch to ``feed_dir`` in order and let the query that ``start`` gives consume it before the next.

    The query reads :func:`arrivals` of ``feed_dir``.
    """
    hadoop = staged.sparkSession._jvm.org.apache.hadoop.fs
    files = hadoop.Path(feed_dir).getFileSystem(staged.sparkSession._jsc.hadoopConfiguration())
    query = None
    try:
        for number, value in enumerate(values):
            arrival = staged.where(F.col(batch_col) == F.lit(value)).select(*columns)
            hidden = f"{feed_dir}/_next-{number}"
            arrival.write.format(fmt).save(hidden)
            if not files.rename(hadoop.Path(hidden), hadoop.Path(f"{feed_dir}/arrival-{number:06d}")):
                raise RuntimeError(f"arrival {number} of {feed_dir} is there already")
            query = query or start()  # the folder exists from the first arrival on
            query.processAllAvailable()
    finally:
        if query:
            query.stop()
