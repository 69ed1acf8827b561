"""Small helpers the training-data operators share."""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.session import work_dir

# A table is broadcast only when it was counted first and has at most this many rows of fixed, small width
# (keys and numbers, under 100 bytes a row); beyond it the same join is left to a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the cluster's shared folder and read it back.

    A lost executor then costs a re-read of files that every executor sees, not a recomputation.
    """
    spark = df.sparkSession
    path = work_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if counting it proves at most ``rows`` rows, else as it is.

    Call it on a saved table of narrow rows: the count is a metadata read there.
    """
    return F.broadcast(df) if df.count() <= rows else df


def values(column, rows: int = 256):
    """The Python values of an Arrow column, made a few rows at a time: a task holds few texts as objects."""
    for start in range(0, len(column), rows):
        yield from column.slice(start, rows).to_pylist()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """``docs``, after setting its session to Arrow batches of at most ``rows`` rows.

    A batch of whole texts is held by the JVM and by its Python worker at once; Spark's default of 10,000 rows suits
    narrow rows.
    """
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS, "10000")) <= rows:
        conf.set(ARROW_ROWS, str(rows))
    return docs


class Hashes(dict):
    """64-bit hashes of words, kept for the next time; ``bounded`` restarts it when it has grown too large."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def bounded(self, most: int) -> "Hashes":
        if len(self) > most:
            self.clear()
        return self
