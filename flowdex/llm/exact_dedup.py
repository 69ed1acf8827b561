"""Exact dedup by progressive refinement, in DataFrame functions only.

1. One scan counts rows by (length of the normalised text, hash of its first ``PREFIX`` characters), combined on the
   map side.  A length, and then a (length, prefix) pair, that only one row has is done with.
2. A second scan hashes the full content, but only of rows whose pair survived.
3. Rows with the same full hash form a group; the smallest id stays.

Texts are equal when identical after replacing each run of ASCII white space by one space; null counts as empty.
The prefix is only a cheap filter between the length and the full hash: equality is decided on the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, small, table, text_or_empty

WHITE = r"[\x20\x09-\x0D]+"
PREFIX = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), WHITE, " ")


def _with_full_hash(docs: DataFrame, text_col: str) -> DataFrame:
    """``(row, norm, full)``: every column of ``docs`` in ``row``; ``full`` is null where no other row can be equal."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       normalised(F.col(f"`{text_col}`")).alias("norm"))
    rows = rows.withColumn("len", F.length("norm")).withColumn(
        "prefix", F.xxhash64(F.substring("norm", 1, PREFIX)))
    sizes = saved(rows.groupBy("len", "prefix").agg(F.count("*").alias("n")), "sizes")
    lengths = sizes.groupBy("len").agg(F.sum("n").alias("same")).filter("same > 1").select("len")
    pairs = saved(sizes.filter("n > 1").join(lengths, "len", "left_semi")
                  .select("len", "prefix", F.lit(True).alias("open")), "pairs")
    rows = rows.join(small(pairs), ["len", "prefix"], "left")
    return rows.select("row", "norm", F.when(F.col("open"), F.sha2(F.encode("norm", "UTF-8"), 256)).alias("full"))


def _groups(hashed: DataFrame, id_col: str) -> DataFrame:
    return (hashed.filter("full is not null").groupBy("full")
            .agg(F.min(f"row.{id_col}").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept`` (and ``text_sha256`` with ``digest``).

    Null texts equal empty ones.  A row repeated with id and text is one group in which exactly one row is kept.
    Null ids stay only where a group has no other id.  Other columns are not read.  No rows give no rows.
    """
    hashed = _with_full_hash(docs.select(id_col, text_col), text_col)
    cols = [F.col(f"row.{id_col}").alias(id_col), "full"]
    if digest:
        cols.append(F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"))
    narrow = saved(hashed.select(*cols), "hashed")
    groups = saved(narrow.select(F.struct(id_col).alias("row"), "full").transform(lambda d: _groups(d, id_col)), "groups")
    extra = ["text_sha256"] if digest else []
    alone = narrow.filter("full is null").select(
        id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        *extra)
    # Rows that repeat an id and a text are counted, then written out again, the first of them as the kept one.
    grouped = (narrow.filter("full is not null").groupBy(id_col, "full", *extra).agg(F.count("*").alias("n"))
               .join(small(groups), "full", "left"))
    keep = F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id"))
    grouped = (grouped.select(id_col, keep.alias("keep_id"),
                              F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), *extra,
                              F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
               .select(id_col, "keep_id", "group_size",
                       (F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), *extra))
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the smallest id, all columns as they were.

    Where a row repeats id and text, one of its rows stays.
    """
    hashed = _with_full_hash(docs, text_col).select("row", "full")
    groups = saved(_groups(hashed, id_col).select("full", "keep_id", F.lit(True).alias("shared")), "groups")
    marked = hashed.join(small(groups), "full", "left")
    alone = marked.filter("shared is null").select("row.*")
    first = (marked.filter(F.col("shared") & F.col(f"row.{id_col}").eqNullSafe(F.col("keep_id")))
             .dropDuplicates(["full"]).select("row.*"))
    return alone.unionByName(first)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), digest=True)


ORACLE = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) text_sha256 from documents)
select doc_id, min(doc_id) over w keep_id, count(*) over w group_size,
       doc_id = min(doc_id) over w kept, text_sha256
from t window w as (partition by text_sha256)
"""
