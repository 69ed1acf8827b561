"""Approximate nearest neighbours by learned partitions.

1. A bounded sample (``SAMPLE_PER_PART`` vectors for each of at most ``MAX_PARTS`` partitions, chosen by a hash of the
   id) is joined into a neighbour graph, and the graph is cut into balanced parts: halving along principal directions
   gives a start, moves that keep the parts within their capacity then keep more neighbours together.
2. A small classifier (multinomial logistic regression) learns the parts of a vector's neighbours.  It puts *every* row
   into its most probable part.  A query goes to its most probable parts until their probabilities reach ``mass``, the
   least one that finds ``RECALL`` of the neighbours of sampled vectors that the classifier didn't learn from: a query it
   is sure of is asked in few parts, another one in many.  Parts with too few rows for an answer are filled up with the
   next ones.  Tables of any size are searched so; a sample of four vectors a part or less can't be learned from and is one
   part.
3. Rows and routed queries meet in tiles of at most about ``TILE_ROWS`` x ``TILE_QUERIES``: a part of any size is as many
   blocks as it needs, so nearly equal vectors don't gather in one task.  Each tile reranks by exact inner products.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowdex.llm.common import saved, table

MAX_PARTS = 1024
SAMPLE_PER_PART = 128     # sampled vectors per part (at least MIN_SAMPLE, at most MAX_SAMPLE in all)
MIN_SAMPLE, MAX_SAMPLE = 4096, 32_768
GRAPH = 10                # neighbours of a vector in the graph
SLACK = 1.1               # a part holds at most this many times its even share of the sample
RECALL = 0.95             # share of the sample's neighbours that the probed parts must hold
TILE_ROWS, TILE_QUERIES = 4096, 4096
TILE_SCORES = 512         # queries of a tile that are scored at a time


def parts_for(rows: int) -> int:
    """The power of two nearest to a 16th of the square root of the table's rows, 2 at least."""
    return min(MAX_PARTS, 1 << max(1, round(math.log2(math.sqrt(max(rows, 1)) / 16))))


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest_rows(x: np.ndarray, asked: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of ``x`` of largest inner product with each of the rows ``asked``, itself excepted."""
    out = np.empty((len(asked), min(k, len(x) - 1)), np.int64)
    for i in range(0, len(asked), 1024):
        own = asked[i:i + 1024]
        s = x[own] @ x.T
        s[np.arange(len(s)), own] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product of each row, itself excepted."""
    return nearest_rows(x, np.arange(len(x)), k)


def balanced_cut(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 6) -> np.ndarray:
    """Part of each row: halves along principal directions, then moves to the part that holds most neighbours."""
    part = np.zeros(len(x), np.int64)
    width = 1
    while width < parts:
        for p in range(width):
            own = np.flatnonzero(part == p)
            centred = x[own] - x[own].mean(axis=0)
            _, axes = np.linalg.eigh(centred.T @ centred)
            order = np.argsort(centred @ axes[:, -1], kind="stable")
            part[own[order[len(own) // 2:]]] += width
        width *= 2
    linked = [[] for _ in x]
    for i, near in enumerate(graph.tolist()):
        linked[i] += near
        for j in near:
            linked[j].append(i)
    limit = int(SLACK * len(x) / parts) + 1
    size = np.bincount(part, minlength=parts).tolist()
    part = part.tolist()
    for _ in range(rounds):
        moved = 0
        for i, near in enumerate(linked):
            votes: dict[int, int] = {}
            for j in near:
                votes[part[j]] = votes.get(part[j], 0) + 1
            own = votes.get(part[i], 0)
            best = max(votes, key=lambda p: (votes[p], -p))
            if votes[best] > own and size[best] < limit:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return np.array(part)


class Router:
    """Logistic regression from a vector to its part, and the probability of the parts that a query is asked in."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, scale: float, mass: float = 0.0):
        self.weights, self.bias, self.scale, self.mass = weights, bias, scale, mass

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x * self.scale) @ self.weights + self.bias

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.logits(x).argmax(axis=1)

    def ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of each row, most probable first, and the probability of all that come before each."""
        s = self.logits(x)
        order = np.argsort(-s, axis=1, kind="stable")
        p = np.exp(np.take_along_axis(s, order, axis=1) - s.max(axis=1, keepdims=True))
        before = np.cumsum(p, axis=1) - p
        return order, before / p.sum(axis=1, keepdims=True)

    def probed(self, x: np.ndarray, sizes: np.ndarray, least: int, probes: int | None = None):
        """The parts of each row and which of them it is asked in: up to ``mass`` (or ``probes`` of them), and on until
        they hold ``least`` rows (all parts, if they hold fewer)."""
        order, before = self.ranked(x)
        held = sizes[order]
        ask = np.arange(order.shape[1]) < probes if probes else before <= self.mass
        return order, ask | (np.cumsum(held, axis=1) - held < least)


def fit(x: np.ndarray, parts: int, k: int, seed: int = 11, epochs: int = 30) -> Router:
    """Cut the sample's neighbour graph, learn the classifier from soft targets, choose ``mass`` on rows left out."""
    d = x.shape[1]
    if parts == 1:
        return Router(np.zeros((d, 1)), np.zeros(1), 1.0)
    graph = neighbour_graph(x, GRAPH)
    part = balanced_cut(x, graph, parts)
    target = np.zeros((len(x), parts))
    for column in (np.arange(len(x)), *graph.T):
        target[np.arange(len(x)), part[column]] += 1
    target /= target.sum(axis=1, keepdims=True)
    scale = math.sqrt(d) / max(1e-12, float(np.sqrt((x * x).sum(axis=1)).mean()))
    rng = np.random.default_rng(seed)
    shuffled = rng.permutation(len(x))
    asked, learned = np.split(shuffled, [min(1000, len(x) // 5)])
    w, b = np.zeros((d, parts)), np.zeros(parts)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(learned)
        for i in range(0, len(order), 256):
            own = order[i:i + 256]
            z = x[own] * scale
            s = z @ w + b
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p = p / p.sum(axis=1, keepdims=True) - target[own]
            step += 1
            for v, g, m, q in ((w, z.T @ p / len(own) + 1e-5 * w, state[0], state[1]),
                               (b, p.mean(axis=0), state[2], state[3])):
                m += 0.1 * (g - m)
                q += 0.01 * (g * g - q)
                v -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.99 ** step)) + 1e-8)
    router = Router(w, b, scale)
    home = router.home(x)
    near = nearest_rows(x, asked, k)
    order, before = router.ranked(x[asked])
    found = (home[near][:, :, None] == order[:, None, :]).argmax(axis=2)  # the probe that reaches each neighbour
    router.mass = float(np.quantile(np.take_along_axis(before, found, axis=1), RECALL, method="higher"))
    return router


def _best(query_ids, row_ids, queries, rows, k):
    """The ``k`` best rows of each query in a tile, with inner products summed the same way for every pair."""
    scores = queries @ rows.T
    scores[query_ids[:, None] == row_ids[None, :]] = -np.inf
    if scores.shape[1] > k:
        # The product of matrices may round equal vectors apart: whatever lies within that error stays for the exact sum.
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        error = 1e-12 * np.sqrt((queries ** 2).sum(axis=1)) * max(1e-300, float(np.sqrt((rows ** 2).sum(axis=1)).max()))
        i, j = np.nonzero((scores >= (least - error)[:, None]) & (scores > -np.inf))
    else:
        i, j = np.nonzero(scores > -np.inf)
    exact = np.concatenate([(queries[i[a:a + 50_000]] * rows[j[a:a + 50_000]]).sum(axis=1)
                            for a in range(0, len(i), 50_000)] or [np.empty(0)])
    order = np.lexsort((row_ids[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    keep = place < k
    return query_ids[i[keep]], row_ids[j[keep]], exact[keep]


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows found of largest inner product, nearest first, ties to small ids.

    Queries are the rows whose id is divisible by ``every``; candidates all other rows.  Vectors that are null, zero or
    hold null or non-finite components take no part, nor do null ids and vectors of another length than the most common.
    Of rows that repeat an id, one takes part (the one with the smallest vector).  No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v")))
    rows = saved(rows, "vectors")
    sizes = {r["d"]: r["n"] for r in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "d").limit(1).collect()}
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], empty)
    (d, n), = sizes.items()
    rows = rows.filter(F.size("v") == d)
    parts = parts_for(n)
    wanted = min(MAX_SAMPLE, max(MIN_SAMPLE, SAMPLE_PER_PART * parts))
    sample = (rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < 1_000_003 * wanted / n)
              .limit(2 * MAX_SAMPLE).toPandas().sort_values("id"))
    router = fit(np.array(sample["v"].tolist(), np.float64).reshape(len(sample), d), parts if len(sample) > 4 * parts
                 else 1, k)
    parts = len(router.bias)

    def vectors_of(batch):
        return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                home = router.home(vectors_of(batch)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], names=["id", "v", "part"])

    placed = saved(rows.select("id", "v").mapInArrow(place, "id long, v array<double>, part int"), "placed")
    sizes = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").count().collect():  # at most MAX_PARTS numbers
        sizes[r["part"]] = r["count"]

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                order, ask = router.probed(vectors_of(batch), sizes, k + 1, probes)
                offsets = np.concatenate([[0], np.cumsum(ask.sum(axis=1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(order[ask].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), lists], names=["id", "v", "probed"])

    asked = saved(placed.filter(F.col("id") % every == 0).select("id", "v")
                  .mapInArrow(route, "id long, v array<double>, probed array<int>"), "asked")
    asked = asked.select("id", "v", F.explode("probed").alias("part"))
    # At most MAX_PARTS rows, counted with a combine on the map side.
    blocks = (placed.groupBy("part").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("rb"))
              .join(asked.groupBy("part").agg(F.ceil(F.count("*") / TILE_QUERIES).cast("int").alias("qb")), "part"))
    blocks = F.broadcast(saved(blocks, "blocks"))
    own = (placed.select("id", "v", "part").join(blocks, "part")
           .withColumn("r", F.pmod(F.xxhash64("id"), F.col("rb")).cast("int"))
           .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("qb") - 1))).select("part", "r", "q", "id", "v"))
    ask = (asked.join(blocks, "part")
           .withColumn("q", F.pmod(F.xxhash64("id"), F.col("qb")).cast("int"))
           .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
           .select("part", "r", "q", "id", "v").toDF("ask_part", "ask_r", "ask_q", "ask_id", "ask_v"))

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
                                 "score": np.empty(0)})
        ids, asked = left["ask_id"].to_numpy(), np.stack(left["ask_v"].to_numpy())
        row_ids, held = right["id"].to_numpy(), np.stack(right["v"].to_numpy())
        best = [_best(ids[a:a + TILE_SCORES], row_ids, asked[a:a + TILE_SCORES], held, k)
                for a in range(0, len(ids), TILE_SCORES)]
        out = [np.concatenate(c) for c in zip(*best)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), out)))

    found = (ask.groupBy("ask_part", "ask_r", "ask_q").cogroup(own.groupBy("part", "r", "q"))
             .applyInPandas(rerank, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
