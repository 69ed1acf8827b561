"""Conflict-constrained best-fit packing of documents into bins of a fixed number of tokens.

* A document longer than a bin is cut into pieces; every piece but the last fills a bin alone, so only remainders are
  packed.
* Rows are dealt by a hash of the id into shards of about ``SHARD_ROWS`` rows, as many as the table needs; a shard is
  packed by one task and owns its bins.  A source or a group of copies of any size is spread over all shards.
* Within a shard the longest remainder goes first.  Open bins are kept in order of their residual space; each carries a
  bitmap of its sources and one of its duplicate clusters.  The search starts at the tightest bin with enough space and
  goes on to its successors until a bin has neither the document's source nor its cluster; else a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, table, text_or_empty
from flowdex.llm.exact_dedup import normalised

CAPACITY = 2048      # tokens of a bin
SHARD_ROWS = 2000    # rows that one task packs at a time, about
NO_CONFLICT = -1


def pack(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each remainder, in order of decreasing length (ties: given order).

    ``sources`` and ``clusters`` are small numbers (bits); a negative one is in conflict with nothing.  Bins are numbered
    in the order they open.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[tuple[int, int]] = []   # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        source = 0 if sources[i] < 0 else 1 << int(sources[i])
        cluster = 0 if clusters[i] < 0 else 1 << int(clusters[i])
        at = bisect_left(open_bins, (need, -1))
        for place in range(at, len(open_bins)):
            residual, b = open_bins[place]
            if not (held_sources[b] & source or held_clusters[b] & cluster):
                del open_bins[place]
                break
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        bins[i], offsets[i] = b, capacity - residual
        held_sources[b] |= source
        held_clusters[b] |= cluster
        if residual > need:
            insort(open_bins, (residual - need, b))
    return bins, offsets


def word_count(text: Column) -> Column:
    """Words of a whole text: runs of characters other than white space."""
    cleaned = F.trim(F.regexp_replace(text_or_empty(text), r"\s+", " "))
    return F.when(cleaned == "", 0).otherwise(F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit(""))) + 1)


def packed(items: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pack ``items(doc_id, source, cluster, length)``: ``doc_id, piece, bin_id, offset, length``, a row for each piece.

    ``bin_id`` names the shard and the bin in it.  Null or negative lengths count as 0; a row of length 0 has one piece of
    length 0, which takes no space but still needs a bin without conflict.  Null sources and clusters are in conflict with
    nothing.  Rows that repeat an id are packed as documents of their own.  No rows give no rows.
    """
    rows = items.select("doc_id", F.col("source").cast("string").alias("source"),
                        F.col("cluster").cast("long").alias("cluster"),
                        F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(0)), F.lit(0)).alias("length"))
    # Equal rows are counted and written out again with a number, so that they too are dealt to all shards.
    rows = saved(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "items")
    total = rows.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "length", "cluster", "copy"), F.lit(shards)))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def one_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "length", "source", "cluster"], kind="stable").reset_index(drop=True)
        shard = int(pdf["shard"].iloc[0])
        length = pdf["length"].to_numpy(np.int64)
        full = np.maximum(0, -(-length // capacity) - 1)
        rest = length - full * capacity
        sources = pd.factorize(pdf["source"])[0]
        clusters = pd.factorize(pdf["cluster"])[0]
        bins, offsets = pack(rest, sources, clusters, capacity)
        last = pd.DataFrame({"doc_id": pdf["doc_id"], "piece": full, "bin": bins, "offset": offsets, "length": rest})
        who = np.repeat(np.arange(len(pdf)), full)
        piece = np.arange(len(who)) - np.repeat(np.cumsum(full) - full, full)
        own = pd.DataFrame({"doc_id": pdf["doc_id"].iloc[who].to_numpy(), "piece": piece,
                            "bin": bins.max(initial=-1) + 1 + np.arange(len(who)), "offset": 0, "length": capacity})
        out = pd.concat([last, own], ignore_index=True)
        out["bin_id"] = [f"{shard}-{b}" for b in out["bin"]]
        out["piece"] = out["piece"].astype(np.int32)
        return out[["doc_id", "piece", "bin_id", "offset", "length"]]

    return rows.groupBy("shard").applyInPandas(
        one_shard, f"doc_id {kind}, piece int, bin_id string, offset long, length long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """Pack whole texts by their words; documents of one source, or of equal texts, never share a bin."""
    text = F.col(text_col)
    return packed(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              F.xxhash64(normalised(text)).alias("cluster"), word_count(text).alias("length")), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
