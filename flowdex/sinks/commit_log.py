"""A directory of micro-batches that readers see batch by batch: attempts and manifest entries that name the valid one.

``<root>/batch_id=<id>/attempt=<name>/`` holds one attempt at a batch, ``<root>/_manifest/<id>-<version>.json`` the name of
one that counted from then on.  A writer adds a new attempt, then an entry with the next version, which appears by one
rename to a name that wasn't there; nothing is replaced.  A reader takes the last version of each batch: one that comes
before the entry gets the old attempt whole, one that comes after it the new one, and none sees a batch half replaced or
missing.  Older attempts and entries stay until :func:`vacuum`, so that readers that began earlier can finish.

One writer at a time writes a batch, as a streaming query does; a second one that commits the same version fails.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.sinks.files import batch_path

MANIFEST = "_manifest"
ENTRY_SCHEMA = "batch_id bigint, version bigint, attempt string"


def _manifest(spark: SparkSession, root: str):
    """(Hadoop's classes, the manifest's folder, its filesystem)"""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{root.rstrip('/')}/{MANIFEST}")
    return hadoop, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, root: str, batch_id: int, attempt: str) -> None:
    hadoop, folder, files = _manifest(spark, root)
    old = files.globStatus(hadoop.Path(folder, f"{batch_id}-*.json")) or []
    version = 1 + max((int(f.getPath().getName()[:-len(".json")].partition("-")[2]) for f in old), default=0)
    temporary, target = hadoop.Path(folder, f"{attempt}.new"), hadoop.Path(folder, f"{batch_id}-{version}.json")
    out = files.create(temporary, True)
    try:
        # A row as Spark reads it; ids are numbers and names hexadecimal, so nothing needs escaping.
        out.write(bytearray(f'{{"batch_id":{batch_id},"version":{version},"attempt":"{attempt}"}}\n'.encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(temporary, target):
        raise RuntimeError(f"batch {batch_id} of {root} was committed by another writer")


def write_committed(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet") -> str:
    """Write one attempt at a batch and make it the valid one; returns the attempt's name."""
    attempt = uuid.uuid4().hex
    df.write.format(fmt).save(f"{batch_path(root, batch_id)}/attempt={attempt}")
    _publish(df.sparkSession, root, int(batch_id), attempt)
    return attempt


def committed(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(batch id, valid attempt) in order: one pair per batch comes to the driver."""
    try:
        entries = spark.read.schema(ENTRY_SCHEMA).json(f"{root.rstrip('/')}/{MANIFEST}/*.json")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    last = entries.groupBy("batch_id").agg(F.max_by("attempt", "version").alias("attempt"))
    return sorted((r["batch_id"], r["attempt"]) for r in last.collect())


def read_committed(spark: SparkSession, root: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """The valid attempts of all batches at this moment, with their ``batch_id``.

    The manifest is read first and the attempts it names after it, so later commits change nothing in the result.
    """
    found = committed(spark, root)
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if not found:
        if not schema:
            raise ValueError(f"no batch is committed in {root}: give the schema of an empty table")
        return spark.createDataFrame([], f"{schema}, batch_id int")
    paths = [f"{batch_path(root, b)}/attempt={a}" for b, a in found]
    return reader.option("basePath", root).load(paths).drop("attempt")


def vacuum(spark: SparkSession, root: str, older_seconds: float = 24 * 3600) -> list[str]:
    """Remove attempts that don't count and entries that are superseded, both older than ``older_seconds``; their paths."""
    hadoop, folder, files = _manifest(spark, root)
    valid, limit = dict(committed(spark, root)), (time.time() - older_seconds) * 1000
    old = []
    for batch in files.listStatus(folder.getParent()):
        name = batch.getPath().getName()
        if name.startswith("batch_id="):
            kept = f"attempt={valid.get(int(name.partition('=')[2]))}"
            old += [a for a in files.listStatus(batch.getPath()) if a.getPath().getName() != kept]
    versions: dict[str, list] = {}
    for entry in files.globStatus(hadoop.Path(folder, "*.json")) or []:
        number, _, version = entry.getPath().getName()[:-len(".json")].partition("-")
        versions.setdefault(number, []).append((int(version), entry))
    for entries in versions.values():
        old += [e for _, e in sorted(entries, key=lambda e: e[0])[:-1]]
    gone = [f.getPath() for f in old if f.getModificationTime() <= limit]
    for path in gone:
        files.delete(path, True)
    return [path.toString() for path in gone]
