"""Pages by fixed key buckets equal offset/limit at every depth."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowdex.operators.paging import bucket_of, global_rank, page, page_by, rank_by

ROWS = 230_003  # over the size below which Spark's range partitioning samples the whole input


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    path = f"file:{tmp_path_factory.mktemp('paging')}/wide"
    key = (F.col("id") * 7919 % ROWS).alias("k")
    (spark.range(ROWS).select((key * 3).alias("k"), F.col("id").alias("v"),
                              F.concat(F.lit("body "), F.col("id").cast("string")).alias("body"))
     .repartition(9).write.parquet(path))
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("tenth", range(11))
@pytest.mark.parametrize("columns", [["k"], ["k", "v", "body"]])
def test_page_at_every_tenth(wide, tenth, columns):
    drop = ROWS * tenth // 10
    got = [r["k"] for r in page(wide.select(*columns), "k", drop, 40, bucket_rows=10_000).collect()]
    assert got == [3 * i for i in range(drop, min(ROWS, drop + 40))]


def test_global_rank_is_exact(wide):
    ranked = global_rank(wide, "k", "rank", bucket_rows=10_000)
    assert ranked.columns == [*wide.columns, "rank"]
    assert ranked.where(F.col("rank") != F.col("k") / 3 + 1).count() == 0 and ranked.count() == ROWS


@pytest.mark.parametrize("drop,take", [(0, 10), (250, 40), (990, 50), (5, None), (0, None), (1000, 5), (0, 0)])
@pytest.mark.parametrize("bucket_rows", [7, 100, 200_000])
def test_page_equals_offset_limit(spark, drop, take, bucket_rows):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.col("id").alias("v")).repartition(6)
    got = [tuple(r) for r in page(df, "k", drop, take, bucket_rows=bucket_rows).collect()]
    ordered = df.orderBy("k").offset(drop)
    assert got == [tuple(r) for r in (ordered.limit(take) if take is not None else ordered).collect()]


def test_empty_null_and_time_keys(spark):
    assert page(spark.range(0), "id", 3, 4).collect() == []
    some = spark.createDataFrame([(3,), (None,), (1,)], "k int")
    assert [r["k"] for r in page(some, "k").collect()] == [1, 3]
    times = spark.range(100).select(F.timestamp_seconds("id").alias("t"), "id")
    assert [r["id"] for r in page(times, "t", 50, 3, bucket_rows=9).collect()] == [50, 51, 52]


def test_page_filter_reaches_the_reader(wide):
    plan = page(wide, "k", 100_000, 10, bucket_rows=10_000)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k," in plan and "LessThanOrEqual(k," in plan


def test_rank_equals_a_window(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k"))
    both = global_rank(df, "k", "rank", bucket_rows=333).withColumn("w", F.row_number().over(Window.orderBy("k")))
    assert both.where("rank <> w").count() == 0


def test_whole_rows_are_fetched_for_the_page_alone(wide):
    plan = page(wide, "k", 100_000, 10, bucket_rows=10_000)._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("_we0"):] if "_we0" in plan else plan
    below = [line for line in plan.splitlines() if "row_number" in line and "min(" not in line and "__place" not in line]
    assert below and not any("body" in line for line in below) and ranked


def test_pages_with_equal_keys(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    for drop, take in ((0, 10), (65, 30), (490, 40)):
        got = [r["k"] for r in page(df, "k", drop, take, bucket_rows=50).collect()]
        assert got == [r["k"] for r in df.orderBy("k").offset(drop).limit(take).collect()]


def test_bucket_lookup_is_a_binary_search(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5.5, 0.0, 0.1, 3.0, 3.5, 9.0, 1e9]], "x double")
    cuts = [0.0, 0.1, 3.0, 9.0]
    got = [r[1] for r in df.select("x", bucket_of(F.col("x"), cuts, df.schema["x"].dataType)).collect()]
    assert got == [0, 0, 0, 1, 2, 3, 3, 4]


@pytest.fixture(scope="module")
def heavy(spark):
    """Four of five rows share one text key; nulls too."""
    return spark.range(4000).select(
        F.when(F.col("id") % 5 < 4, F.lit("inbox")).when(F.col("id") % 25 == 4, F.lit(None))
        .otherwise(F.concat(F.lit("b"), (F.col("id") % 13).cast("string"))).alias("folder"),
        (F.col("id") * 7919 % 4000).alias("msg_no"), F.col("id").alias("v")).repartition(6)


@pytest.mark.parametrize("drop,take", [(0, 5), (1500, 40), (3990, 30), (200, None), (9000, 3)])
def test_pages_by_text_and_number(spark, heavy, drop, take):
    got = [tuple(r) for r in page_by(heavy, ["folder", "msg_no"], drop, take).collect()]
    ordered = heavy.orderBy("folder", "msg_no").offset(drop)
    assert got == [tuple(r) for r in (ordered if take is None else ordered.limit(take)).collect()]


def test_a_heavy_value_is_cut_by_the_second_key(spark, heavy):
    ranked = rank_by(heavy, ["folder", "msg_no"])
    w = Window.orderBy("folder", "msg_no")
    want = heavy.select("folder", "msg_no", F.row_number().over(w).cast("long").alias("rank"))
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    parts = heavy.select("folder", "msg_no").repartitionByRange(4, "folder", "msg_no").where("folder = 'inbox'")
    assert parts.select(F.spark_partition_id()).distinct().count() >= 3
    assert page_by(heavy.limit(0), ["folder", "msg_no"], 0, 3).collect() == []
