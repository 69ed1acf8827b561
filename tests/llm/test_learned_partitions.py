import numpy as np
import pytest

from flowdex.llm import learned_partitions as lp

SCHEMA = "vec_id long, embedding array<float>, score string, part int"


def brute(rows, k=20, every=20):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(v, good.get(i, v))
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids], np.float32).astype(np.float64)
    out = []
    for a in np.flatnonzero(ids % every == 0):
        s = (x[a] * x).sum(axis=1)
        order = [b for b in np.lexsort((ids, -s)) if b != a][:k]
        out += [(int(ids[a]), r + 1, int(ids[b]), s[b]) for r, b in enumerate(order)]
    return out


def test_all_parts_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(200)]
    same = rows[7][1]
    rows += [(i, same) for i in range(300, 380)]  # ties
    rows += [(20, rows[20][1]), (500, None), (501, [0.0] * 4), (502, [1.0, None, 0.0, 0.0]), (520, [1.0, 2.0]),
             (None, same), (540, [float("nan"), 1.0, 0.0, 0.0]), (560, [float("inf"), 1.0, 0.0, 0.0]), (580, [])]
    df = spark.createDataFrame([(a, b, "clash", 0) for a, b in rows], SCHEMA)
    got = sorted(tuple(r) for r in lp.nearest(df, probes=2).collect())
    want = sorted(brute(rows))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-14)


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 0.0, 0.0, 0.0])]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame([(a, b, "clash", 0) for a, b in rows], SCHEMA)
    assert lp.nearest(df).collect() == []


def test_recall_and_tiles_of_a_hot_part(spark, monkeypatch):
    monkeypatch.setattr(lp, "TILE_ROWS", 64)
    monkeypatch.setattr(lp, "TILE_QUERIES", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 4)).astype(np.float32)
    x[::3] = x[0] + 0.001 * rng.normal(size=(len(x[::3]), 4))  # a third of all rows lie together
    rows = list(enumerate(x.tolist()))
    got = lp.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(got) == len(want) == 200 * 20
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert all([a for a, *_ in sorted(g)] == list(range(1, 21)) and sorted(g) == sorted(g, key=lambda x: x[1:])
               for g in by.values())


def test_cut_is_balanced():
    x = np.random.default_rng(1).normal(size=(1000, 8))
    part = lp.balanced_cut(x, lp.neighbour_graph(x, 10), 8)
    assert np.bincount(part, minlength=8).max() <= lp.SLACK * 125 + 1


@pytest.mark.parametrize("n", [1, 8, 25, 60, 500, 2000])
def test_recall_on_small_tables(spark, n):
    """The router works on them, too, and every query gets all the rows it can."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 4)) + 6 * rng.normal(size=(9, 4))[rng.integers(9, size=n)]
    rows = list(enumerate(x.astype(np.float32).tolist()))
    got = [(r.query_id, r.vec_id) for r in lp.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()]
    want = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(got) == len(set(got)) == len(want) and len(set(got) & want) >= 0.9 * len(want)


def test_queries_are_asked_in_as_many_parts_as_they_need():
    rng = np.random.default_rng(6)
    centres = 8 * rng.normal(size=(16, 16))
    x = centres[rng.integers(16, size=6000)] + rng.normal(size=(6000, 16))
    router = lp.fit(x[:4000], 8, 20)
    sizes = np.bincount(router.home(x), minlength=8)
    order, ask = router.probed(x[4000:], sizes, 21)
    near = lp.nearest_rows(x, np.arange(4000, 6000), 20)
    reached = np.zeros((2000, 8), bool)
    np.put_along_axis(reached, order, ask, axis=1)
    assert np.take_along_axis(reached, router.home(x)[near], axis=1).mean() >= 0.9
    assert ask.sum(axis=1).mean() < 4 and (ask.sum(axis=1) >= 1).all()
    assert (np.where(ask, sizes[order], 0).sum(axis=1) >= 21).all()
    assert router.probed(x[:5], np.full(8, 2), 21)[1].all()  # too few rows: all parts
