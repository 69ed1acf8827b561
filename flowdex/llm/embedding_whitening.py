"""Embedding whitening by a weighted covariance over distinct vectors.

1. Each usable row becomes its vector ``x`` of whole numbers; identical ``x`` are one distinct vector with a count
   (combined on the map side, so a vector that most rows share is one row per task of the shuffle).
2. The fit list is the distinct vectors, each with weight one or its count.  Sums are exact whole numbers; the weighted,
   centred product ``sum w (x - S/n) (x - S/n)^T`` is made block by block in the tasks.
3. The driver sees the sums and the d x d matrix alone and takes its eigenvectors.
4. Each distinct vector is whitened once; the rows get its result by a join on the vector's 128-bit key.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
FLAT = 1e-12            # components with less than this share of the largest variance have no direction
BLOCK = 4096            # vectors multiplied at a time
LARGEST = 2.0 ** 40     # entries from here on have no exact place among 64-bit sums
WEIGHTS = ("one", "count")


def _lengths(rows: DataFrame, vec_col: str) -> int:
    """The commonest length of the usable vectors (of equally common ones the largest); 0 without any."""
    top = rows.groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of the rows whose vector is there, not empty, and holds finite entries below ``LARGEST`` only."""
    v = F.col(f"`{vec_col}`")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= LARGEST))
    return (vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(v.isNotNull() & (F.size(v) > 0) & ~bad, v).alias("v"))
            .filter("v is not null"))


def _matrix(column, d: int, kind) -> np.ndarray:
    """An Arrow column of fixed-width binary values as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)


def whole_numbers(rows: DataFrame, d: int) -> DataFrame:
    """``(id, key, x)``: x is ``floor(64 c) + 1000000`` of every entry, as 64-bit numbers in a row; key its hash."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(-1, d)
            packed = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(p) for p in packed], pa.binary()),
                 pa.array(packed, pa.binary())], names=["id", "key", "x"])

    return rows.filter(F.size("v") == d).mapInArrow(run, f"id {kind}, key binary, x binary")


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(total weight, weighted sum of each dimension), exact."""

    def run(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x, w = _matrix(batch.column(0), d, np.int64), batch.column(1).to_numpy()
            n += int(w.sum())
            # Blocks small enough for 64 bits; the running total is a whole number of any size.
            for at in range(0, len(x), BLOCK):
                part = (x[at:at + BLOCK].astype(object) * w[at:at + BLOCK, None]).sum(axis=0) if w.max() > 1 else \
                    x[at:at + BLOCK].sum(axis=0)
                total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, d), pa.int32()), pa.array([str(n)] + [str(t) for t in total], pa.string())], names=["i", "s"])

    rows = (fit.select("x", "w").mapInArrow(run, "i int, s string").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    got = {r["i"]: int(r["s"]) for r in rows}
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def _product(rows: DataFrame, d: int, centred) -> np.ndarray:
    """``sum w c c^T`` over the rows; ``centred`` makes the matrix ``c`` of a block of the first column's values."""
    upper = np.triu_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            w = batch.column(1).to_numpy().astype(np.float64)
            c = centred(batch.column(0))
            for at in range(0, len(c), BLOCK):
                part = c[at:at + BLOCK]
                total += (part * w[at:at + BLOCK, None]).T @ part
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "s"])

    out = np.zeros((d, d))
    # At most d (d + 1) / 2 numbers.
    for r in rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def _means(rows: DataFrame, k: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(k)
        for batch in batches:
            total += (_matrix(batch.column(0), k, np.float64) * batch.column(1).to_numpy()[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], names=["i", "s"])

    out = np.zeros(k)
    for r in rows.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r["i"]] = r["s"]
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           weight: str = "one") -> DataFrame:
    """Rows ``id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    ``weight``: every distinct vector counts once ("one") or as often as it occurs ("count"); ``n`` is the total weight.
    Null, empty and non-finite vectors (and entries of ``LARGEST`` or more) give no rows; neither do vectors of another
    length than the commonest (of equally common ones the largest).  Repeated rows repeat theirs, null ids keep theirs.
    Fewer than ``components`` dimensions give as many components.  A component without variance (at most ``FLAT`` of the largest) is whitened to 0.0 and takes
    no part in ``identity_error``.  No usable rows give no rows; other columns are not read.  ``deviation`` is exact; it
    is null where it is beyond 64 bits.
    """
    if weight not in WEIGHTS:
        raise ValueError(f"weight must be one of {WEIGHTS}")
    rows = usable(vectors, id_col, vec_col)
    d = _lengths(rows, "v")
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if not d:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = saved(whole_numbers(rows, d), "whole")
    counted = rows.groupBy("key", "x").agg(F.count("*").alias("c"))
    fit = saved(counted.select("key", "x", (F.lit(1).cast("long") if weight == "one" else F.col("c")).alias("w")), "distinct")
    n, sums = _sums(fit, d)
    # n * x - S is a whole number: centred exactly, then divided.  Of the mean its floor is taken off first.
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(Fraction(s % n, n)) for s in sums])

    def centred(column):
        return (_matrix(column, d, np.int64) - base) - rest

    covariance = _product(fit.select("x", "w"), d, centred) / n
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:min(components, d)]
    values, directions, trace = np.maximum(values[order], 0.0), directions[:, order], float(np.trace(covariance))
    live = values > FLAT * max(values[0], 1e-300)
    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1.0)), 0.0)
    k = len(order)
    left = [s % n for s in sums]

    def run(batches):
        for batch in batches:
            c = centred(batch.column(1))
            z = (c @ directions) * scale
            whole = _matrix(batch.column(1), d, np.int64) - base
            most = max(1, int(np.abs(whole).max(initial=0)) + 1) * n
            if most * most * d < 2 ** 62:
                far = whole * n - np.array(left, np.int64)
                deviation = (far * far).sum(axis=1).tolist()
            else:
                far = whole.astype(object) * n - np.array(left, object)
                deviation = [v if v < 2 ** 63 else None for v in map(int, (far * far).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(deviation, pa.int64()), pa.array([r.tobytes() for r in z], pa.binary()),
                 pa.array(list(z), pa.list_(pa.float64()))], names=["key", "w", "deviation", "packed", "z"])

    done = saved(fit.select("key", "x", "w").mapInArrow(
        run, "key binary, w long, deviation long, packed binary, z array<double>"), "whitened")
    mean = _means(done.select("packed", "w"), k) / n
    check = _product(done.select("packed", "w"), k, lambda column: _matrix(column, k, np.float64) - mean) / n
    error = float(np.abs((check - np.eye(k))[np.ix_(live, live)]).max(initial=0.0))
    explained = [float(v / trace) if trace > 0 else 0.0 for v in values]
    shares = F.array(*[F.lit(v) for v in explained])
    # The narrow side may repeat a key very often: it is a saved table, whose skew the join may split.
    found = rows.select("id", "key").join(done.select("key", "deviation", "z"), "key")
    return found.select("id", "deviation", F.posexplode("z").alias("pos", "whitened")).select(
        F.col("id").alias(id_col), (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("pos")).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
