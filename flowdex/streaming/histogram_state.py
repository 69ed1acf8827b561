"""Running histogram across micro-batches, kept in levelled runs that are partitioned by a hash of the value.

A *run* holds the counts of a range of batches.  Every batch writes a run of its own (level 0); where ``K = compact_every``
runs of a level are complete, they become one run of the next level.  After ``n`` batches the runs are the digits of ``n``
to base ``K``: at most ``K - 1`` of each of about ``log_K n`` levels, and each count is rewritten once a level.

* ``level=<i>/slot=<j>/part=<p>``  ``histo_valu, n`` of run ``j`` (modulo ``2 K``) of level ``i``; ``p`` is a hash of the
  value into ``parts``;
* ``meta/slot=<id % 2>``  one row: the field, ``K``, the parts and the last batch, written last by every batch.

A batch looks up its values in the partitions they hash to, of every run, and nowhere else: what it reads follows its own
values, not all values ever seen.  Only the partition numbers of the batch come to the driver (at most ``parts``).

The layout follows from ``K`` and the batch ids, so a state is only continued with the settings it was written with, by
its last batch again or by the one after it.  Anything else (another setting, a new checkpoint on an old state, a missing
or older state) is refused instead of counted wrongly.

Storage stays bounded without any delete call: a slot is reused ``2 K`` runs later, when its run has long been merged.
Every file a batch writes is a pure function of the batch and of files that it doesn't replace, so the latest batch re-run
after an executor or driver failure rewrites the same files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_SUPP, HISTO_VALU, doc_to_json, histogram_tags, merge_docs
from flowdex.operators.histogram import field_support, with_documents

STATE_SCHEMA = f"{HISTO_VALU} string, n bigint, part int"
META_SCHEMA = "field string, compact_every int, parts int, batch_id bigint"
DEFAULT_COMPACT_EVERY = 10
DEFAULT_PARTS = 64


class HistogramState:
    def __init__(self, state_dir: str, field: str, compact_every: int = DEFAULT_COMPACT_EVERY,
                 on_missing: str = "skip", parts: int = DEFAULT_PARTS):
        """``parts``: so many that a part of all values ever seen fits a task; fixed for the life of a state."""
        if compact_every < 1 or parts < 1:
            raise ValueError("compact_every and parts must be >= 1")
        self.state_dir = state_dir.rstrip("/")
        self.field = field
        self.compact_every = compact_every
        self.parts = parts
        self.on_missing = on_missing
        self._held: DataFrame | None = None

    # ------------------------------------------------------------ layout
    @property
    def _base(self) -> int:
        return max(2, self.compact_every)  # with one run a level, two are the least that can be merged

    def run_path(self, level: int, start: int) -> str:
        """The run of ``level`` that begins with batch ``start``."""
        return f"{self.state_dir}/level={level}/slot={start // self._base ** level % (2 * self._base)}"

    def runs(self, batches: int) -> list[tuple[int, int]]:
        """(level, first batch) of the runs that hold the first so many batches, largest first."""
        level, out, start = 0, [], 0
        while self._base ** (level + 1) <= batches:
            level += 1
        for i in range(level, -1, -1):
            while start + self._base ** i <= batches:
                out.append((i, start))
                start += self._base ** i
        return out

    # ------------------------------------------------------------ reading
    def _read(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        reader = spark.read.schema(STATE_SCHEMA).option("basePath", self.state_dir)
        return reader.parquet(*[self.run_path(*r) for r in runs]).select(HISTO_VALU, "n", "part")

    def lookup(self, spark: SparkSession, batch_id: int, parts: Sequence[int]) -> DataFrame:
        """All counts up to ``batch_id`` in the given parts (a filter on the partition column)."""
        return self._read(spark, self.runs(batch_id + 1)).where(F.col("part").isin(list(parts) or [-1]))

    def _meta(self, spark: SparkSession):
        """The metadata row of the last batch, or None where no state was ever written."""
        try:
            rows = spark.read.schema(META_SCHEMA).parquet(f"{self.state_dir}/meta")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return rows.orderBy(F.desc("batch_id")).select("field", "compact_every", "parts", "batch_id").first()

    def _check(self, spark: SparkSession, batch_id: int) -> None:
        meta = self._meta(spark)
        if meta is None:
            if batch_id:
                raise ValueError(f"no histogram state in {self.state_dir}, but batch {batch_id} needs the ones before it")
            return
        if (meta["field"], meta["compact_every"], meta["parts"]) != (self.field, self.compact_every, self.parts):
            raise ValueError(f"the state in {self.state_dir} is of field {meta['field']!r} with compact_every="
                             f"{meta['compact_every']} and parts={meta['parts']}, not {self.field!r} with "
                             f"{self.compact_every} and {self.parts}")
        if batch_id not in (meta["batch_id"], meta["batch_id"] + 1):
            raise ValueError(f"the state in {self.state_dir} ends with batch {meta['batch_id']}; batch {batch_id} doesn't "
                             "follow it (a new checkpoint on an old state, or a lost one)")

    def load(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Full state after ``batch_id`` (None before the first batch or if it was never run)."""
        meta = self._meta(spark) if batch_id >= 0 else None
        if meta is None or meta["batch_id"] < batch_id:
            return None  # only the latest batches are readable: older slots get reused
        return _summed(self._read(spark, self.runs(batch_id + 1)))

    # ------------------------------------------------------------ writing
    def advance(self, docs: DataFrame, batch_id: int) -> DataFrame:
        """Record this batch; return the support (over batches <= ``batch_id``) of its values."""
        spark = docs.sparkSession
        self._check(spark, batch_id)
        out = self._advance(spark, docs, batch_id)
        # A row made by the JVM: createDataFrame would start a Python worker for it.
        (spark.range(1, numPartitions=1).select(
            F.lit(self.field).alias("field"), F.lit(self.compact_every).cast("int").alias("compact_every"),
            F.lit(self.parts).cast("int").alias("parts"),
            F.lit(batch_id).cast("bigint").alias("batch_id"))
         .write.mode("overwrite").parquet(f"{self.state_dir}/meta/slot={batch_id % 2}"))
        return out

    def _write(self, counts: DataFrame, run: tuple[int, int]) -> None:
        (counts.select(HISTO_VALU, "n", "part").sortWithinPartitions("part", HISTO_VALU)
         .write.mode("overwrite").partitionBy("part").parquet(self.run_path(*run)))

    def _advance(self, spark: SparkSession, docs: DataFrame, batch_id: int) -> DataFrame:
        part = F.pmod(F.xxhash64(HISTO_VALU), F.lit(self.parts)).cast("int")
        own = (0, batch_id)
        self._write(field_support(docs).withColumn("part", part), own)
        batches, level = batch_id + 1, 0
        while batches % self._base ** (level + 1) == 0:
            level += 1
        if level:
            # The runs of the lower levels since the last run of this level, and the batch's own, become one.
            first = batches - self._base ** level
            runs = [r for r in self.runs(batch_id) if r[1] >= first] + [own]
            merged = self._read(spark, runs).repartition("part").groupBy("part", HISTO_VALU).agg(F.sum("n").alias("n"))
            self._write(merged, (level, first))
        present = self._read(spark, [own])
        parts = [r["part"] for r in present.select("part").distinct().collect()]
        return _summed(self.lookup(spark, batch_id, parts).join(present.select(HISTO_VALU), HISTO_VALU, "left_semi"))

    def enrich_batch(self, batch: DataFrame, batch_id: int, value_col: str = "value",
                     keep: Sequence[str] = ()) -> DataFrame:
        """One micro-batch -> enriched documents (``doc``, ``histo_valu``, ``histo_supp``, JSON ``value``)."""
        self.release()
        # Parsed once: the documents are counted, then joined.  Released after the sink wrote them, or by the next batch.
        docs = with_documents(batch, self.field, value_col, self.on_missing).persist()
        self._held = docs
        support = self.advance(docs, batch_id).withColumnRenamed("n", HISTO_SUPP)
        joined = docs.join(support, HISTO_VALU, "left")
        tagged = F.when(F.col(HISTO_VALU).isNotNull(),
                        merge_docs("doc", histogram_tags(self.field, HISTO_VALU, HISTO_SUPP))
                        ).otherwise(F.col("doc"))
        return joined.select(*keep, tagged.alias("doc"), HISTO_VALU, HISTO_SUPP,
                             doc_to_json(tagged).alias("value"))

    def release(self) -> None:
        """Give up the documents kept for the last batch."""
        if self._held is not None:
            self._held.unpersist()
            self._held = None


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy(HISTO_VALU).agg(F.sum("n").alias("n"))
