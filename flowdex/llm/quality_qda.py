"""Quality classifier: regularised quadratic discriminant analysis of transformed document statistics.

* ``statistics`` turns each whole text into ``FEATURES`` numbers (shares and logarithms of counts), in one pass.
* ``fit`` adds up, per class, the count, the sums and the products of the features over *all* labelled training rows;
  only these sums (a few hundred numbers a class) reach the driver.
* Each class covariance is shrunk towards the pooled covariance and its diagonal; its Cholesky factor is computed once
  and kept in the model.  A score is the logistic function of the difference of the class log-densities, each from the
  Mahalanobis length of the features in the factor's coordinates, and of the class shares.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, table, text_batches, values

SHRINK = 0.2      # weight of the pooled covariance in a class covariance
DIAGONAL = 0.1    # weight of the pooled diagonal
FLOOR = 1e-3      # least variance of a feature
FEATURES = ("log_words", "log_word_length", "upper", "marks", "symbols", "digits", "shouts", "bars", "newlines",
            "distinct_words", "repeated_lines", "log_line_words", "stops", "mark_runs", "other_script")
_RUN = re.compile(r"[^\w\s]{2,}")


def _root(part: float, whole: float) -> float:
    """Square root of a share: spreads the small shares that matter, and bounds the large ones."""
    return math.sqrt(part / whole) if whole else 0.0


def features(text: str | None) -> list[float]:
    """The statistics of one whole text; a null or empty text has zeros (and equals every other empty text)."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    chars, n = len(text), len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "ignore"), np.uint8), minlength=256)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    digits = int(counts[48:58].sum())
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    symbols = int(counts[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 94, 126]].sum())
    lines = [x for x in text.split("\n") if x.strip()]
    runs = _RUN.findall(text)
    return [
        math.log1p(n),
        math.log1p(chars / n),
        _root(upper, upper + lower),
        _root(marks, chars),
        _root(symbols, chars),
        _root(digits, chars),
        _root(int(counts[33]), n),
        _root(int(counts[124]), n),
        _root(len(lines), n),
        len(set(words)) / n,
        _root(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / max(1, len(lines))),
        _root(int(counts[46]), n),
        _root(len(runs), n),
        _root(int(counts[128:].sum()), chars),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x)`` of every row, ``x`` an array of ``FEATURES``."""

    def run(batches):
        for batch in batches:
            rows = [features(t) for t in values(batch.column(1))]
            flat = np.array(rows, np.float64).ravel()
            offsets = pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.float64()))], names=["id", "x"])

    src = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, x array<double>")


class Discriminant:
    """Class means, cached Cholesky factors, log-determinants and log-shares."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, products: np.ndarray):
        d = sums.shape[1]
        self.classes = [k for k in range(2) if counts[k] > 0]
        self.parts = {}
        if len(self.classes) < 2:
            return
        means = sums / counts[:, None]
        spread = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = spread.sum(axis=0) / max(1.0, counts.sum() - 2)
        pooled = pooled + FLOOR ** 2 * np.eye(d)
        for k in self.classes:
            own = spread[k] / max(1.0, counts[k] - 1)
            shrunk = ((1 - SHRINK - DIAGONAL) * own + SHRINK * pooled + DIAGONAL * np.diag(np.diag(pooled)))
            factor = np.linalg.cholesky(shrunk)
            self.parts[k] = (means[k], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(),
                             math.log(counts[k] / counts.sum()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of the rows of ``x``; with one class learned, its certainty; with none, one half."""
        if len(self.classes) < 2:
            return np.full(len(x), float(self.classes[0]) if self.classes else 0.5)
        log = []
        for k in (0, 1):
            mean, inverse, determinant, share = self.parts[k]
            z = (x - mean) @ inverse.T
            log.append(share - 0.5 * (determinant + np.einsum("ij,ij->i", z, z)))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 1 when divided by 3, and rows without id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant:
    """Learn from the rows of ``stats(id, x)`` that aren't held out and have a label 0 or 1.

    An id with labels of both kinds teaches nothing; a repeated label counts once.
    """
    truth = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
             .filter("y = z").select("id", "y"))
    rows = stats.filter(~held_out(F.col("id"))).join(truth, "id").select("y", "x")
    d = len(FEATURES)

    def add_up(batches):
        counts, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for k in (0, 1):
                own = x[y == k]
                counts[k] += len(own)
                sums[k] += own.sum(axis=0)
                products[k] += own.T @ own
        for k in (0, 1):
            if counts[k]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([counts[k]], pa.float64()),
                     pa.array([np.concatenate([sums[k], products[k].ravel()]).tolist()], pa.list_(pa.float64()))],
                    names=["y", "n", "s"])

    parts = (rows.mapInArrow(add_up, "y int, n double, s array<double>")
             .select("y", "n", F.posexplode("s").alias("i", "v"))
             .groupBy("y", "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())
    counts, flat = np.zeros(2), np.zeros((2, d + d * d))
    for r in parts:
        counts[r["y"]] = r["n"]
        flat[r["y"], r["i"]] = r["v"]
    return Discriminant(counts, flat[:, :d], flat[:, d:].reshape(2, d, d))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """id, ``held_out``, ``score`` (of label 1), ``predicted`` for every row of ``docs``.

    Null texts count as empty; empty and very long texts are scored like others; repeated rows get equal scores.  Without
    labels of both kinds the score is that of the only kind, and one half without any.  No rows give no rows.  Only the
    text feeds a score; other columns are not read.
    """
    stats = saved(statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, labels, id_col, label_col)

    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            got = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got, pa.float64()),
                 pa.array((got >= 0.5).astype(np.int32), pa.int32())], names=["id", "held_out", "score", "predicted"])

    kind = stats.schema["id"].dataType.simpleString()
    return (stats.select("id", held_out(F.col("id")).alias("held_out"), "x")
            .mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")
            .withColumnRenamed("id", id_col))


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
