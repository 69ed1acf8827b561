"""The histogram join on its large-scale plan: no broadcast, skew-split sort-merge join.

One value holds 40% of the messages; AQE is forced to split its partitions.
The result must equal the window oracle exactly.
"""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowdex.operators import histogram

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def test_enrich_under_forced_skew_join(spark, capsys):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        rng = random.Random(11)
        rows = [(i, rng.randrange(3), "hot" if rng.random() < 0.4 else f"v{rng.randrange(50)}")
                for i in range(4000)]
        df = spark.createDataFrame(rows, "id int, batch int, v string").repartition(8)
        msgs = df.select("id", "batch", F.to_json(F.struct("v")).alias("value"))
        out = histogram.enrich(msgs, "v")
        out.explain()
        assert "SortMergeJoin" in capsys.readouterr().out
        found = out.select("id", "histo_supp")
        got = {r["id"]: r["histo_supp"] for r in found.collect()}
        found.explain()
        final = capsys.readouterr().out
        assert "SortMergeJoin(skew=true)" in final  # the hot value's partitions were split
        w = Window.partitionBy("v").orderBy("batch").rangeBetween(Window.unboundedPreceding, 0)
        expected = {r["id"]: r["s"] for r in df.select("id", F.count(F.lit(1)).over(w).alias("s")).collect()}
        assert got == expected
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
