"""Exact ``drop``/``take`` paging in a global order without funnelling rows through one task.

By one number or time (:func:`page`, :func:`global_rank`):

1. one aggregate (``percentile_approx``) gives cut points of the order key; they come to the driver as literals, at
   most ``BUCKET_LIMIT`` numbers, and stay fixed from then on, so every later job puts a row into the same bucket;
2. one aggregate counts the rows of each bucket, which gives each bucket's offset;
3. rank = offset + place within the bucket.  A page ranks only the keys of the buckets it touches (a range filter, which
   reaches the parquet reader), keeps those it shows, and fetches whole rows for them alone.

A bucket holds about ``BUCKET_ROWS`` keys, so no task ranks more; a table of more than ``BUCKET_LIMIT`` times as many
rows has larger buckets, whose sort may spill.  Rows without a key are in no page; rows of one key come in any order.

By any columns (:func:`page_by`, :func:`rank_by`), text and many equal values included: the narrow keys are range-partitioned
by all order columns with Spark's sampled splitters, so a value that most rows share is cut by the columns behind it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowdex.session import work_dir

BUCKET_ROWS = 200_000     # rows ranked by one task, about
BUCKET_LIMIT = 4096       # most buckets: their boundaries are literals of one expression
FETCH_LIMIT = 100_000     # most keys of a page that are broadcast to fetch their rows


def cut_points(keys: DataFrame, order_col: str, bucket_rows: int = BUCKET_ROWS) -> list:
    """Fixed, ascending, distinct bucket boundaries of a key; none where one bucket is enough."""
    n = keys.where(F.col(order_col).isNotNull()).count()
    buckets = min(BUCKET_LIMIT, -(-n // bucket_rows))
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    row = keys.select(F.percentile_approx(order_col, shares, max(10_000, 20 * buckets)).alias("cuts")).first()
    return sorted(set(row["cuts"]))


def bucket_of(key: Column, cuts: list, kind) -> Column:
    """Number of cut points below the key: bucket ``i`` is ``(cut i-1, cut i]``.  A binary search in one array literal."""
    if not cuts:
        return F.lit(0)
    name = kind.simpleString()
    if isinstance(cuts[0], (int, float)):
        array = F.split(F.lit(",".join(map(repr, cuts))), ",").cast(f"array<{name}>")  # folded once, by the optimizer
    else:
        array = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]

    def jump(low, step):
        return F.when(F.coalesce(F.get(array, low + step - 1) < key, F.lit(False)), low + step).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), jump)


def _bucket_offsets(keys: DataFrame, order_col: str, cuts: list) -> tuple[list[int], list[int]]:
    """(offset, size) of every bucket: one aggregate, one row per bucket."""
    kind = keys.schema[order_col].dataType
    bucket = bucket_of(F.col(order_col), cuts, kind)
    counts = {r["b"]: r["n"] for r in keys.where(F.col(order_col).isNotNull()).groupBy(bucket.alias("b"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(len(cuts) + 1)]
    offsets, total = [], 0
    for size in sizes:
        offsets.append(total)
        total += size
    return offsets, sizes


def _ranked(df: DataFrame, order_col: str, cuts: list, offsets: list[int], rank_col: str) -> DataFrame:
    kind = df.schema[order_col].dataType
    if not cuts:
        one = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order_col))
        return df.where(F.col(order_col).isNotNull()).withColumn(rank_col, (one + offsets[0]).cast("long"))
    # One number per bucket, bounded by BUCKET_LIMIT: a literal, so no join and no column of a second table.
    starts = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(order_col))
    return (df.where(F.col(order_col).isNotNull())
            .withColumn("__bucket", bucket_of(F.col(order_col), cuts, kind))
            .withColumn(rank_col, F.get(starts, F.col("__bucket")) + within).drop("__bucket"))


def global_rank(df: DataFrame, order_col: str, rank_col: str = "__rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add the 1-based position of each row in ``order_col`` order; the rows of a bucket are ranked by one task."""
    keys = df.select(order_col)
    cuts = cut_points(keys, order_col, bucket_rows)
    return _ranked(df, order_col, cuts, _bucket_offsets(keys, order_col, cuts)[0], rank_col)


def page(df: DataFrame, order_col: str, drop: int = 0, take: int | None = None,
         keys: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows ``drop+1 .. drop+take`` of ``df`` in ``order_col`` order (to the end without ``take``).

    ``keys`` may name a cheaper table with the same keys, such as the one ``df`` was joined from; the cut points and
    counts are then read from it.
    """
    keys = (df if keys is None else keys).select(order_col)
    cuts = cut_points(keys, order_col, bucket_rows)
    offsets, sizes = _bucket_offsets(keys, order_col, cuts)
    ends = [o + s for o, s in zip(offsets, sizes)]
    last_rank = ends[-1] if take is None else min(ends[-1], drop + take)
    first = min(bisect_left(ends, drop + 1), len(ends) - 1)
    last = min(bisect_left(ends, max(last_rank, 1)), len(ends) - 1)
    kind = df.schema[order_col].dataType

    def in_range(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col(order_col).isNotNull())
        if first > 0:
            rows = rows.where(F.col(order_col) > F.lit(cuts[first - 1]).cast(kind))
        if last < len(cuts):
            rows = rows.where(F.col(order_col) <= F.lit(cuts[last]).cast(kind))
        return rows

    rows = in_range(df)
    if take is None or take > FETCH_LIMIT:  # most of the table: its rows are ranked themselves
        ranked = _ranked(rows, order_col, cuts, offsets, "__rank")
        return ranked.where((F.col("__rank") > drop) & (F.col("__rank") <= last_rank)).orderBy(order_col).drop("__rank")
    # At most FETCH_LIMIT keys are on the page.  Equal keys share the rank of their first row and are told apart below.
    ranked = _ranked(in_range(keys), order_col, cuts, offsets, "__rank")
    ranked = ranked.withColumn("__first", F.min("__rank").over(Window.partitionBy(order_col)))
    shown = (ranked.where((F.col("__rank") > drop) & (F.col("__rank") <= last_rank))
             .select(F.col(order_col).alias("__key"), "__first").distinct())
    found = rows.join(F.broadcast(shown), F.col(order_col) == F.col("__key")).drop("__key")
    place = F.col("__first") + F.row_number().over(Window.partitionBy(order_col).orderBy(order_col)) - 1
    found = found.withColumn("__place", place).where((F.col("__place") > drop) & (F.col("__place") <= last_rank))
    return found.orderBy(order_col).drop("__first", "__place")


def _sorted_keys(keys: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """The keys sorted over partitions, kept as a table with ``part`` and ``at``, and (part, first ``at``, rows) of each.

    One row per partition comes to the driver.
    """
    spark, path = keys.sparkSession, work_dir(keys.sparkSession, "sorted_keys")
    source = keys.select(*order)
    spread = source.repartitionByRange(*order).sortWithinPartitions(*order)
    (spread.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
     .write.parquet(path))
    kept = spark.read.schema(f"{_ddl(source)}, __part int, __at bigint").parquet(path)
    sizes = kept.groupBy("__part").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    return kept, sorted((r["__part"], r["first"], r["n"]) for r in sizes)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _with_rank(kept: DataFrame, sizes: list[tuple[int, int, int]], rank_col: str) -> DataFrame:
    offsets, total = [], 0
    for part, first, n in sizes:
        offsets.append((part, total - first))
        total += n
    # One row per partition, which their number bounds.
    table = F.broadcast(kept.sparkSession.createDataFrame(offsets, "__part int, __shift bigint"))
    return kept.join(table, "__part").withColumn(rank_col, F.col("__at") + F.col("__shift") + 1).drop("__part", "__at", "__shift")


def rank_by(keys: DataFrame, order: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """The ``order`` columns of every row and its 1-based position in their order (nulls first).

    Rows that are equal in all of them have different ranks, in any order.
    """
    kept, sizes = _sorted_keys(keys, order)
    return _with_rank(kept, sizes, rank_col)


def page_by(df: DataFrame, order: Sequence[str], drop: int = 0, take: int | None = None) -> DataFrame:
    """Rows ``drop+1 .. drop+take`` of ``df`` by the ``order`` columns (nulls first), which must tell all rows apart.

    Only the order columns are sorted; whole rows are fetched for the page's keys.
    """
    kept, sizes = _sorted_keys(df, order)
    ends, total, touched = drop + take if take is not None else None, 0, []
    for part, _, n in sizes:  # only partitions that hold some of the page
        if total + n > drop and (ends is None or total < ends):
            touched.append(part)
        total += n
    if not touched:
        return df.limit(0)
    ranked = _with_rank(kept.where(F.col("__part").isin(touched)), sizes, "__rank")
    shown = ranked.where(F.col("__rank") > drop)
    if ends is not None:
        shown = shown.where(F.col("__rank") <= ends)
    shown = shown.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(order)])
    if take is not None and take <= FETCH_LIMIT:
        shown = F.broadcast(shown)
    match = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(order)]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return df.join(shown, condition, "left_semi").orderBy(*order)
