"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (combined on the map side) and a join on the node.  The minima are written before they
are joined: a join that shared the aggregate's shuffle would keep all edges of a node in one task, while two plain
shuffles may be split where a node has very many.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved


def _mark(edges: DataFrame):
    """Row count and order-free fingerprint of an edge table (two numbers)."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` -> ``(node, component)``: every node on an edge with the smallest node it is connected to.

    Null ends and loops carry no link and are ignored; repeated and reversed edges count once; no edges give no rows.
    Raises if ``max_rounds`` do not suffice (each round at least halves path lengths, so 60 cover any input).
    """
    edges = saved(edges.filter("u is not null and v is not null and u <> v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    if mark[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = saved(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                      "large")
        low = saved(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        parts = large.join(low, "u")
        edges = saved(parts.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
