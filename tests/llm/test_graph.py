import numpy as np

from flowdex.llm.graph import connected_components


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return sorted((x, find(x)) for x in root)


def test_chains_hubs_and_loops(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(1000, 1090)] + [(5, i) for i in range(2000, 2300)] + [(7, 7), (None, 3), (4, None)]
    edges += [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(9, 8), (8, 9), (8, 9)]
    df = spark.createDataFrame(edges, "u long, v long")
    assert sorted(map(tuple, connected_components(df).collect())) == brute(edges)
    assert connected_components(df.limit(0)).collect() == []
    assert connected_components(spark.createDataFrame([(1, 1)], "u long, v long")).collect() == []
