import collections

import numpy as np

from flowdex.llm import best_fit_packing as bf


def scan(lengths, sources, clusters, capacity):
    """The tightest compatible bin by looking at every bin (ties: the bin opened first)."""
    bins, place = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [(b["left"], k) for k, b in enumerate(bins) if lengths[i] <= b["left"] and b["left"] > 0
               and (sources[i] < 0 or sources[i] not in b["s"]) and (clusters[i] < 0 or clusters[i] not in b["c"])]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        place[i] = (k, capacity - bins[k]["left"])
        bins[k]["left"] -= lengths[i]
        bins[k]["s"].add(sources[i])
        bins[k]["c"].add(clusters[i])
    return place


def test_successor_search_equals_a_scan():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = int(rng.integers(1, 150))
        lengths, sources = rng.integers(0, 60, n), rng.integers(-1, 5, n)
        clusters = rng.integers(-1, 20, n)
        bins, offsets = bf.pack(lengths, sources, clusters, 100)
        want = scan(lengths.tolist(), sources.tolist(), clusters.tolist(), 100)
        assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [want[i] for i in range(n)]


def check(rows, lengths, capacity, info):
    pieces, used = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.length))
        used[r.bin_id].append((r.offset, r.length, r.doc_id))
    for i, n in lengths.items():
        got = [x for _, x in sorted(pieces[i])]
        assert sum(got) == n and all(x == capacity for x in got[:-1]) and len(got) == max(1, -(-n // capacity))
    for parts in used.values():
        parts.sort()
        assert all(a[0] + a[1] <= b[0] for a, b in zip(parts, parts[1:])) and parts[-1][0] + parts[-1][1] <= capacity
        for k in (0, 1):
            seen = [info[d][k] for *_, d in parts if info[d][k] is not None]
            assert len(seen) == len(set(seen))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base = docs.collect()
    rows = bf.pack_documents(docs).collect()
    check(rows, {r.doc_id: len(r.text.split()) for r in base}, bf.CAPACITY,
          {r.doc_id: (r.source, " ".join(r.text.split())) for r in base})


def test_edges(spark):
    texts = [(1, None, "a"), (2, "", "a"), (3, "w " * 50_000, "a"), (4, "x y", None), (5, "x  y", "b"), (6, "x y", "c"),
             (7, " \n", None)]
    docs = spark.createDataFrame([(*t, 5, "clash") for t in texts],
                                 "doc_id long, text string, source string, length int, cluster string")
    rows = bf.pack_documents(docs, capacity=64).collect()
    check(rows, {i: len((t or "").split()) for i, t, _ in texts}, 64,
          {i: (s, None if not (t or "").strip() else " ".join(t.split())) for i, t, s in texts})
    assert bf.pack_documents(docs.limit(0)).collect() == []
    again = docs.union(docs)
    assert len(bf.pack_documents(again, capacity=64).collect()) == 2 * len(rows)
