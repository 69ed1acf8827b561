import itertools

import numpy as np
import pytest

from flowdex.llm import minhash_join as mj

SCHEMA = "doc_id long, text string, class_id string, `key` int"


def brute(rows):
    shingler = mj.Shingler()
    sets = [(i, set(shingler(t).tolist())) for i, t in rows]
    links = [0] * len(sets)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and len(x & y) / len(x | y) >= mj.THRESHOLD:
            links[a] += 1
            links[b] += 1
            p, q = find(a), find(b)
            if sets[p][0] <= sets[q][0]:
                root[q] = p
            else:
                root[p] = q
    return sorted((s[0], sets[find(k)][0], n) for k, (s, n) in enumerate(zip(sets, links)))


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = sorted(tuple(r) for r in mj.similar_classes(docs).collect())
    assert got == want and any(n for *_, n in got)


def test_edges_and_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    base = list(rng.choice(words, 120))
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "x " * 60_000), (7, " ".join(base)),
            (7, " ".join(base))]
    for i in range(60):  # a group of near copies, all different
        near = list(base)
        for at in rng.integers(0, 120, 1 + i % 3):
            near[at] = f"n{i}"
        rows.append((100 + i, " ".join(near)))
    monkeypatch.setattr(mj, "TILE_SHINGLES", 1000)  # several tiles for the group
    docs = spark.createDataFrame([(a, b, "clash", 0) for a, b in rows], SCHEMA)
    assert sorted(tuple(r) for r in mj.similar_classes(docs).collect()) == brute(rows)
    kept = mj.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(b[0] for b in brute(rows) if b[0] == b[1])


def test_empty_table(spark):
    assert mj.similar_classes(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_bands_reach_the_recall(threshold):
    bands, rows = mj.bands_for(threshold, 0.99)
    assert 1 - (1 - threshold ** rows) ** bands >= 0.99


def test_unrelated_texts_of_one_id_stay(spark):
    words = [f"w{i}" for i in range(200)]
    a, c = " ".join(words[:100]), " ".join(words[100:])
    near = a + " tail"
    rows = [(1, a), (2, near), (2, c), (3, c + " end"), (None, near), (None, "nothing like it at all here"), (4, "own words of a row"),
            (5, None), (5, ""), (1, c + " of one")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, row string, id int")
    got = mj.one_per_class(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    # Classes: {1 a, 2 near, none near} and {1 c of one, 2 c, 3 c end}.
    want = [(1, a), (1, c + " of one"), (None, rows[5][1]), (4, rows[6][1]), (5, None), (5, "")]
    assert kept == sorted(want, key=str)
    two = spark.createDataFrame([(1, a), (2, near), (2, c)], "doc_id long, text string")
    assert sorted(tuple(r) for r in mj.one_per_class(two).collect()) == [(1, a), (2, c)]
