import random

import numpy as np
import pytest
from pyspark import cloudpickle

from flowdex.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, batch string, kept string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in rows], SCHEMA)


def brute(rows):
    """Every string of every text in one dictionary."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - sd.LEAST + 1 if i is not None else 0):
            s = t[p:p + sd.LEAST]
            first[s] = min(i, first.get(s, i))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - sd.LEAST + 1 if i is not None else 0):
            if first[t[p:p + sd.LEAST]] < i:
                gone[p:p + sd.LEAST] = b"\1" * sd.LEAST
        turn = [k for k in range(len(t) + 1) if (gone[k] if k < len(t) else 0) != (gone[k - 1] if k else 0)]
        out.append((i, len(t), list(zip(turn[::2], turn[1::2])), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def got(spark, rows, **options):
    found = sd.repeated_spans(frame(spark, rows), **options)
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found.collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé ", k=rng.randint(1, 9))) for _ in range(60)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    passages = [prose(rng.randint(8, 40)) for _ in range(8)]
    common = "a phrase that everyone says, in ever new surroundings of it"
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3)
            parts += [p[cut:len(p) - rng.randint(0, 9)], prose(rng.randint(0, 12))]
        if i % 3 == 0:
            parts += [common[:40 + i % 20], prose(3)]
        rows.append((i * 7 % 151, "".join(parts)))
    rows += [(i + 500, rows[i][1]) for i in range(0, 60, 7)]
    return rows


ODD = [(900, None), (901, ""), (902, "z" * 49), (903, "z" * 50), (904, "z" * 70_000), (905, "z" * 60 + "y" * 300),
       (None, "z" * 55), (906, "k" * 60), (906, "k" * 60), (907, "ü" * 25 + "ö" * 40), (908, "ü" * 25), (910, "k" * 60),
       (-5, "q" * 80), (3, "q" * 51)]


@pytest.fixture
def by_value():
    """Changed settings reach the workers only with the module itself."""
    cloudpickle.register_pickle_by_value(sd)
    yield
    cloudpickle.unregister_pickle_by_value(sd)


@pytest.mark.parametrize("hot, batch, entries", [(1000, 4 << 20, 100_000), (2, 3000, 200), (4, 5000, 40)])
def test_against_brute_force(spark, by_value, monkeypatch, hot, batch, entries):
    """Small batches and parts: hot anchors, many splitters and pieces."""
    for name, value in (("BATCH", batch), ("ENTRIES", entries), ("HASHES", 500 if batch < 9999 else 1 << 20), ("WINDOWS", 300),
                        ("PIECE", 1000 if batch < 9999 else 1 << 18)):
        monkeypatch.setattr(sd, name, value)
    rows = corpus(hot) + ODD
    want = brute(rows)
    assert got(spark, rows, hot=hot) == want
    assert sum(len(s) > 0 for _, _, s, _ in want) > 40


def test_overlapping_and_adjacent_matches(spark):
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghij", k=400))
    cuts = [(0, 50), (20, 71), (100, 149), (150, 200), (200, 260), (260, 309), (350, 400)]
    rows = [(i, text[a:b]) for i, (a, b) in enumerate(cuts)] + [(90, text), (91, text[::-1] + text[30:130])]
    assert got(spark, rows) == brute(rows)


def test_anchors_are_of_the_content(spark):
    rng = np.random.default_rng(2)
    buf = rng.integers(97, 100, 3000).astype(np.uint8)
    h = sd.gram_hashes(buf)
    assert len(h) == 3000 - sd.GRAM + 1
    seen = {}
    for i in range(len(h)):
        assert seen.setdefault(buf[i:i + sd.GRAM].tobytes(), h[i]) == h[i]
    assert len(set(seen.values())) == len(seen)
    x = rng.integers(0, 1000, 200)
    assert (sd.sliding_min(x, 33) == [x[i:i + 33].min() for i in range(168)]).all()


def test_multikey_sort():
    rng = np.random.default_rng(4)
    data = np.concatenate([np.tile(rng.integers(97, 99, 60).astype(np.uint8), 20), rng.integers(97, 99, 500).astype(np.uint8)])
    start = np.arange(len(data) - sd.LEAST + 1)
    doc = rng.integers(0, 30, len(start))
    live, low = sd.multikey_sort(sd._words(np.concatenate([data, np.zeros(8, np.uint8)])), start, np.zeros(len(start), np.int64), doc, doc)
    groups = {}
    for s, d in zip(start, doc):
        groups.setdefault(data[s:s + sd.LEAST].tobytes(), []).append(d)
    want = {int(s): min(groups[data[s:s + sd.LEAST].tobytes()]) for s in start
            if len(set(groups[data[s:s + sd.LEAST].tobytes()])) > 1}
    assert dict(zip(start[live].tolist(), low.tolist())) == want


def test_empty_table_and_no_text_moves(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (None, None)]) == brute([(1, None), (None, None)])
    plan = sd.repeated_spans(frame(spark, corpus(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
