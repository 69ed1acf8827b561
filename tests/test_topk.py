"""Two-phase top-k per group equals brute force, including a hot group."""

import random

import pytest
from pyspark.sql import functions as F

from flowdex.operators.topk import top_k_per_group


@pytest.mark.parametrize("threshold", ["1000", "0"])
def test_top_k_matches_brute_force(spark, threshold):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", f"h{i}", rng.randrange(20))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, h string, c int")
    order = [F.col("c").desc(), F.col("h").asc()]
    got = sorted(tuple(r) for r in top_k_per_group(df, ["g"], order, 7, salt_cols=["h"], salt_buckets=8).collect())
    expected = []
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        expected.extend(members[:7])
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == sorted(expected)
