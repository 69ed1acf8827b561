import math
from fractions import Fraction

import numpy as np
import pytest

from flowdex.llm import embedding_whitening as ew

SCHEMA = "vec_id long, embedding array<float>, n string, component string, z int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", 1) for i, v in rows], SCHEMA)


def brute(rows, weight="one"):
    """``{row number: (id, n, deviation, centred x)}`` with whole numbers, and the eigenvalues with their directions."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for _, v in good]
    fit = sorted(set(xs))
    w = [1 if weight == "one" else xs.count(x) for x in fit]
    n, d = sum(w), len(fit[0])
    s = [sum(a * x[k] for a, x in zip(w, fit)) for k in range(d)]
    mean = [Fraction(v, n) for v in s]
    c = np.array([[float(x[k] - mean[k]) for k in range(d)] for x in fit])
    cov = (c * np.array(w)[:, None]).T @ c / n
    values, directions = np.linalg.eigh(cov)
    order = np.argsort(-values)
    dev = [sum((n * x[k] - s[k]) ** 2 for k in range(d)) for x in xs]
    far = np.array([[float(x[k] - mean[k]) for k in range(d)] for x in xs])
    return [i for i, _ in good], n, dev, far, values[order], directions[:, order], np.trace(cov)


def check(got, rows, weight="one"):
    ids, n, dev, far, values, directions, trace = brute(rows, weight)
    k = min(16, len(values))
    assert len(got) == k * len(ids) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-4
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    want = far @ directions[:, :k] / np.sqrt(values[:k])
    for c in range(1, k + 1):
        col = np.array([by[i, c][0].whitened for i in ids])
        assert np.allclose(col, want[:, c - 1], atol=1e-6) or np.allclose(col, -want[:, c - 1], atol=1e-6)
        assert all(abs(by[i, c][0].explained - values[c - 1] / trace) <= 1e-4 * values[c - 1] / trace for i in ids[:3])
    assert all(x.deviation == e for i, e in zip(ids, dev) for x in by[i, 1])


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = ew.query(spark, "/root/testdata/sf0.01").collect()
    check(got, rows)


@pytest.mark.parametrize("weight", ["one", "count"])
def test_copies_and_odd_rows(spark, weight):
    rng = np.random.default_rng(3)
    base = [[float(c) for c in rng.normal(size=5) * [9, 7, 5, 3, 1] + 4] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(40)] + [(7, base[7]), (7, base[9])]
    # Entries that fall into the same step are one vector.
    rows += [(200, [math.floor(c * 64) / 64 for c in map(float, np.float32(base[3]))])]
    odd = [(300, None), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [math.nan] * 5), (304, [math.inf, 0.0, 0.0, 0.0, 0.0]),
           (305, [1.0, 2.0]), (306, [1e30, 0.0, 0.0, 0.0, 0.0])]
    got = ew.whiten(frame(spark, rows + odd), weight=weight).collect()
    ids, n, *_ = brute(rows, weight)
    assert n == (60 if weight == "one" else len(rows)) and {r.vec_id for r in got} == set(ids)
    want_ids, n, dev, far, values, directions, trace = brute(rows, weight)
    keep = [j for j, i in enumerate(want_ids) if i != 7]
    for c in range(5):
        by = {r.vec_id: r.whitened for r in got if r.component == c + 1 and r.vec_id != 7}
        col = np.array([by[want_ids[j]] for j in keep])
        want = (far @ directions[:, c] / math.sqrt(values[c]))[keep]
        assert np.allclose(col, want, atol=1e-6) or np.allclose(col, -want, atol=1e-6)
    assert len([r for r in got if r.vec_id == 7]) == 3 * 5
    assert {r.deviation for r in got if r.vec_id == 200} == {r.deviation for r in got if r.vec_id == 3}


def test_flat_and_empty(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)] + [(None, [1.0, 2.0])]
    got = ew.whiten(frame(spark, same)).collect()
    assert len(got) == 12 and all((r.whitened, r.explained, r.deviation, r.identity_error, r.n) == (0, 0, 0, 0, 1) for r in got)
    line = [(i, [float(i), float(i)]) for i in range(6)]
    got = ew.whiten(frame(spark, line)).collect()
    assert all(r.whitened == 0 for r in got if r.component == 2) and got[0].identity_error < 1e-9
    assert abs(sum(r.whitened ** 2 for r in got if r.component == 1) / 6 - 1) < 1e-9
    empty = ew.whiten(frame(spark, same).limit(0))
    assert empty.collect() == [] and empty.columns == ew.whiten(frame(spark, same)).columns
    assert ew.whiten(frame(spark, [(1, None)])).collect() == []
    big = ew.whiten(frame(spark, [(1, [1e6] * 64), (2, [-1e6] * 64), (3, [0.0] * 64)])).collect()
    assert {r.vec_id: r.deviation for r in big}[3] == 0 and {r.vec_id: r.deviation for r in big}[1] == 64 * (3 * 64 * 10 ** 6) ** 2
    with pytest.raises(ValueError):
        ew.whiten(frame(spark, same), weight="other")
