"""Histogram analyzer on tables: running support of a field's values.

Semantics: a message of micro-batch ``b`` whose field value is ``v`` is tagged
with ``histo_supp`` = the number of messages with value ``v`` in batches <= b
(the current batch included).  A message without the field is passed through
untouched and not counted.

Plan shape (aggregate -> window -> join):

1. ``(batch, value) -> n``: partial + final hash aggregate, so a hot value is
   pre-aggregated on the map side and only its counts are shuffled;
2. running ``sum(n)`` per value ordered by batch: one row per (value, batch), so
   a hot value costs as many rows as there are batches, not messages;
3. left join of the messages to the running counts on ``(batch, value)``.
   The counts side is small; AQE broadcasts it when its measured size is under
   the threshold and otherwise splits skewed message partitions (skew join).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowdex.functions.documents import (HISTO_SUPP, HISTO_VALU, doc_to_json, field_value,
                                         histogram_tags, mapify, merge_docs)
from flowdex.operators.topk import top_k_per_group
from flowdex.session import ensure_map_policy


ON_MISSING = ("skip", "fail")


def with_documents(messages: DataFrame, field: str, value_col: str = "value",
                   on_missing: str = "skip") -> DataFrame:
    """Add ``doc`` (parsed map) and ``histo_valu`` (the field's value).

    ``on_missing="skip"``: a message without the field gets NULL and is passed
    through uncounted.  ``"fail"``: the job fails on the first such message
    (``raise_error`` inside the expression, no driver-side check).
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    ensure_map_policy(messages.sparkSession)
    value = field_value("doc", field)
    if on_missing == "fail":
        value = F.when(value.isNull(), F.raise_error(F.lit(f"message without field '{field}'"))
                       ).otherwise(value)
    return messages.withColumn("doc", mapify(value_col)).withColumn(HISTO_VALU, value)


def field_support_by_batch(docs: DataFrame, batch_col: str = "batch") -> DataFrame:
    """``batch, histo_valu, n``: support of each value within each batch."""
    # Missing values are dropped after the aggregation, through the count of
    # non-null values (0 only for the NULL group).  A filter on the key itself
    # would be pushed below the aggregate and evaluate the whole parse twice.
    return (docs.groupBy(batch_col, HISTO_VALU).agg(F.count(HISTO_VALU).alias("n"))
            .where(F.col("n") > 0))


def field_support(docs: DataFrame) -> DataFrame:
    """``histo_valu, n``: global support (the final state of the running histogram)."""
    return docs.groupBy(HISTO_VALU).agg(F.count(HISTO_VALU).alias("n")).where(F.col("n") > 0)


def running_support(by_batch: DataFrame, batch_col: str = "batch") -> DataFrame:
    """``batch, histo_valu, n``: support up to and including each batch."""
    w = (Window.partitionBy(HISTO_VALU).orderBy(batch_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return by_batch.select(batch_col, HISTO_VALU, F.sum("n").over(w).alias("n"))


def enrich(messages: DataFrame, field: str, batch_col: str = "batch",
           value_col: str = "value", on_missing: str = "skip") -> DataFrame:
    """Tag every message with the running support of its field value.

    Output: the input columns, ``doc`` (enriched map), ``histo_valu`` and
    ``histo_supp`` (BIGINT; NULL for messages without the field).
    """
    docs = with_documents(messages, field, value_col, on_missing)
    support = running_support(field_support_by_batch(docs, batch_col), batch_col)
    support = support.select(F.col(batch_col).alias("__sb"), F.col(HISTO_VALU).alias("__sv"),
                             F.col("n").alias(HISTO_SUPP))
    # Null-safe equality on the value (the support side has no NULL value, so the
    # result is the same): a plain equi-join would let the optimizer infer
    # ``isnotnull(histo_valu)`` and push it through the aggregate into the scan,
    # evaluating the whole JSON parse twice per message.
    cond = (F.col(batch_col) == F.col("__sb")) & F.col(HISTO_VALU).eqNullSafe(F.col("__sv"))
    joined = docs.join(support, cond, "left").drop("__sb", "__sv")
    tagged = F.when(F.col(HISTO_VALU).isNotNull(),
                    merge_docs("doc", histogram_tags(field, HISTO_VALU, HISTO_SUPP))
                    ).otherwise(F.col("doc"))
    return joined.withColumn("doc", tagged)


def render(enriched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Enriched documents -> JSON text ``value``."""
    return enriched.select(*keep, doc_to_json("doc").alias("value"))


def top_k(support: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values (ties by value).  Extension: announced, never built, upstream."""
    return support.orderBy(F.col("n").desc(), F.col(HISTO_VALU).asc()).limit(k)


def running_top_k(running: DataFrame, k: int, batch_col: str = "batch") -> DataFrame:
    """``batch, rank, histo_valu, n``: the ``k`` most frequent values after every batch (ties by value).

    ``running``: :func:`running_support`, a row for each batch in which a value occurs.  A value that a batch lacks keeps
    its support and may keep its rank.  Only the ``k`` best values of each batch are candidates: support never falls, so a
    value outside them is behind ``k`` others from then on.  A candidate is valid from its batch up to its next row; batches
    are cut into about ``sqrt(batches)`` blocks, the best ``k`` of all earlier blocks open a block, and intervals are
    followed within blocks alone: ``k * batches ** 1.5`` rows, however many values there are.
    """
    if k <= 0:
        return running.limit(0).select(batch_col, F.lit(0).alias("rank"), HISTO_VALU, "n")
    order = [F.col("n").desc(), F.col(HISTO_VALU).asc()]
    # One row per batch is numbered.
    batches = running.select(batch_col).distinct().withColumn(
        "idx", F.row_number().over(Window.orderBy(batch_col)).cast("long") - 1)
    total = batches.count()
    if not total:
        return running.limit(0).select(batch_col, F.lit(0).alias("rank"), HISTO_VALU, "n")
    size = max(1, math.isqrt(total))
    last = (total - 1) // size
    best = top_k_per_group(running, [batch_col], order, k, salt_cols=[HISTO_VALU]).join(batches, batch_col)
    best = best.select("idx", F.floor(F.col("idx") / size).alias("block"), HISTO_VALU, "n")

    def leaders(rows: DataFrame) -> DataFrame:
        rows = rows.groupBy("block", HISTO_VALU).agg(F.max("n").alias("n"))
        return top_k_per_group(rows, ["block"], order, k, salt_cols=[HISTO_VALU])

    later = leaders(best).where(F.col("block") < last).select(
        F.explode(F.sequence(F.col("block") + 1, F.lit(last).cast("long"))).alias("block"), HISTO_VALU, "n")
    opening = leaders(later).select((F.col("block") * size).alias("idx"), "block", HISTO_VALU, "n")
    rows = best.unionByName(opening).groupBy("block", HISTO_VALU, "idx").agg(F.max("n").alias("n"))
    end = F.least((F.col("block") + 1) * size, F.lit(total).cast("long"))
    until = F.coalesce(F.lead("idx").over(Window.partitionBy("block", HISTO_VALU).orderBy("idx")), end)
    valid = rows.withColumn("until", until).select(
        HISTO_VALU, "n", F.explode(F.sequence(F.col("idx"), F.col("until") - 1)).alias("idx"))
    ranked = top_k_per_group(valid, ["idx"], order, k, salt_cols=[HISTO_VALU], rank_col="rank")
    return ranked.join(batches, "idx").select(batch_col, "rank", HISTO_VALU, "n")


def top_k_step(previous: DataFrame | None, support: DataFrame, k: int) -> DataFrame:
    """``rank, histo_valu, n`` after a batch, from those before it and the support of the batch's values.

    At most ``k`` rows of ``previous`` and the ``k`` best of ``support`` are ranked.
    """
    rows = support.select(HISTO_VALU, "n").orderBy(F.col("n").desc(), F.col(HISTO_VALU).asc()).limit(k)
    if previous is not None:
        rows = rows.unionByName(previous.select(HISTO_VALU, "n")).groupBy(HISTO_VALU).agg(F.max("n").alias("n"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(HISTO_VALU).asc())))
    return ranked.where(F.col("rank") <= k).select("rank", HISTO_VALU, "n")
