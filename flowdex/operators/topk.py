"""Exact top-k per group without putting a whole group in one task.

For ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by
default) a plain ``row_number() <= k`` is enough: Catalyst plans a partial
``WindowGroupLimit`` on every map partition before the shuffle, so each task of
the final window receives at most ``partitions * k`` rows of a group.

Above the threshold the same two-phase plan is written out by hand: phase 1
ranks inside ``(group, salt)`` buckets, the salt being a hash of the rest of the
row's key, and keeps ``k`` rows per bucket.  Every row of a group's true top-k
survives phase 1 (it is in the top-k of its own bucket), so phase 2 ranks at
most ``salt_buckets * k`` candidates per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 32
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def _planner_limits_groups(df: DataFrame, k: int) -> bool:
    try:
        threshold = int(df.sparkSession.conf.get(GROUP_LIMIT_CONF, "1000"))
    except (TypeError, ValueError):
        return False
    return 0 < k <= threshold


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int, salt_cols: Sequence[str], salt_buckets: int = DEFAULT_SALT_BUCKETS,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order``.

    ``order`` must be a total order within a group for the result to be unique.
    """
    if k <= 0:
        return df.limit(0)
    final = Window.partitionBy(*group_cols).orderBy(*order)
    if _planner_limits_groups(df, k):
        candidates = df
    else:
        salt = F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets))
        local = Window.partitionBy(*group_cols, "__salt").orderBy(*order)
        candidates = (df.withColumn("__salt", salt)
                      .withColumn("__rn", F.row_number().over(local))
                      .where(F.col("__rn") <= k).drop("__rn", "__salt"))
    ranked = candidates.withColumn("__rn", F.row_number().over(final)).where(F.col("__rn") <= k)
    if rank_col:
        return ranked.withColumnRenamed("__rn", rank_col)
    return ranked.drop("__rn")
