"""The schema of a feed's JSON objects, folded over its batches and kept in the shared folder.

``<root>/schema-<version>.json`` holds one schema.  A batch that brings a new member or a wider type adds the next version,
which appears by one rename; any other batch writes nothing.  Folding is idempotent, so the latest batch can be run again
after a failure, whichever side of the rename it stopped on.  One query at a time writes a folder.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowdex.functions.json_types import known, readable, widen
from flowdex.operators.sqlreport import infer_json_schema

KEPT_VERSIONS = 2  # the current one and the one before


class SchemaState:
    """``base`` (DDL) names members that exist before any message has them; their types widen like others."""

    def __init__(self, root: str, base: str | None = None):
        self.root = root.rstrip("/")
        self.base = base

    def _files(self, spark):
        hadoop = spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.root)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(hadoop.Path(folder, "schema-*.json")) or []
        versions = sorted(int(re.search(r"schema-(\d+)\.json$", f.getPath().getName())[1]) for f in found)
        return hadoop, folder, files, versions

    def current(self, spark) -> T.StructType:
        """The schema after all batches so far."""
        *_, versions = self._files(spark)
        if versions:
            text = spark.read.text(f"{self.root}/schema-{versions[-1]}.json", wholetext=True).first()[0]
            return T.StructType.fromJson(json.loads(text))
        return known(T.StructType.fromDDL(self.base)) if self.base else T.StructType([])

    def _publish(self, spark, schema: T.StructType) -> None:
        hadoop, folder, files, versions = self._files(spark)
        version = 1 + max(versions, default=0)
        temporary = hadoop.Path(folder, f"_{version}.new")
        target = hadoop.Path(folder, f"schema-{version}.json")
        out = files.create(temporary, True)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()
        if files.exists(target) or not files.rename(temporary, target):
            raise RuntimeError(f"version {version} of {self.root} was written by another query")
        for old in versions[:-(KEPT_VERSIONS - 1)]:
            files.delete(hadoop.Path(folder, f"schema-{old}.json"), False)

    def advance(self, messages: DataFrame, value_col: str = "value") -> T.StructType | None:
        """Fold in one batch; the schema to parse it with, None while no member is known.

        One aggregate over the batch; only the schema comes to the driver.  A batch without an object changes nothing.
        """
        spark = messages.sparkSession
        before = self.current(spark)
        found = infer_json_schema(messages, value_col)
        after = before if found is None else widen(before, known(T.StructType.fromDDL(found[len("STRUCT<"):-1])))
        if after != before:
            self._publish(spark, after)
        return readable(after) if after.fields else None


def column_profile(records: DataFrame, schema: T.StructType) -> DataFrame:
    """``(column, kind, n)`` of each member: its type without digits and how many records have it."""
    counts = records.agg(*[F.count(F.col(f"`{f.name.replace('`', '``')}`")).alias(f"c{i}") for i, f in enumerate(schema.fields)])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.typeName()).alias("kind"),
                              F.col(f"c{i}").alias("n")) for i, f in enumerate(schema.fields)])
    return counts.select(F.inline(rows))
