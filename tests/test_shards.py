import pytest

from flowdex.session import work_dir
from flowdex.sources import shards
from flowdex.streaming.runner import start_indexing, trigger_of


def test_released_shards():
    lineage = {"a": [], "b": [], "c": ["a", "b"], "d": ["c"], "lost": ["nowhere"], "x": ["y"], "y": ["x"]}
    assert shards.released(lineage, {}, {"a": 3}) == {"a": 0, "b": 0}
    assert shards.released(lineage, {"a": 3}, {"a": 3, "b": 9}) == {"a": 0, "b": 0}
    assert shards.released(lineage, {"a": 3, "b": 2}, {"a": 3, "b": 1}) == {"a": 0, "b": 0}
    assert shards.released(lineage, {"a": 3, "b": 0}, {"a": 3}) == {"a": 0, "b": 0, "c": 1}
    assert shards.released(lineage, {"a": 3, "b": 0, "c": 0}, {"a": 3}) == {"a": 0, "b": 0, "c": 1, "d": 2}


@pytest.fixture
def feed(spark):
    spark.conf.set("spark.sql.streaming.stopTimeout", "30s")
    base = work_dir(spark, "shards")
    got = []

    def put(shard, *values):
        rows = spark.createDataFrame([(bytearray(v.encode()),) for v in values], "value binary")
        shards.append_segment(rows.repartition(2), f"{base}/in", shard)

    def run(fail=False):
        def sink(df, batch_id):
            rows = sorted((r.generation, r.shard, r.segment, bytes(r.value).decode()) for r in df.collect())
            if fail:
                raise RuntimeError("stopped here")
            got.append((batch_id, rows))

        query = start_indexing(shards.read_shards(spark, f"{base}/in"), None, sink, f"{base}/ck", trigger=trigger_of(0))
        try:
            query.processAllAvailable()
        except Exception as e:
            assert fail and "stopped here" in str(e)
        finally:
            query.stop()
        new = [r for _, rows in got for r in rows]
        got.clear()
        return new

    return spark, f"{base}/in", put, run


def test_children_wait_for_their_parents(feed):
    spark, root, put, run = feed
    shards.add_shard(spark, root, "p")
    put("p", "1", "2")
    put("p", "3")
    assert [r[3] for r in run()] == ["1", "2", "3"]
    shards.add_shard(spark, root, "late", ["p"])  # added while nothing runs
    put("late", "c1")
    assert run() == []
    put("p", "4")
    shards.close_shard(spark, root, "p")
    assert run(fail=True) == []
    shards.add_shard(spark, root, "later", ["late"])
    put("later", "g1")
    put("late", "c2")
    assert run() == [(0, "p", 2, "4"), (1, "late", 0, "c1"), (1, "late", 1, "c2")]  # the failed batch, then the rest
    shards.close_shard(spark, root, "late")
    assert run() == [(2, "later", 0, "g1")]
    assert run() == []


def test_empty_shards_and_refusals(feed):
    spark, root, put, run = feed
    shards.add_shard(spark, root, "e")
    shards.close_shard(spark, root, "e")  # never had a record
    shards.add_shard(spark, root, "c", ["e"])
    put("c")
    put("c", "x")
    assert run() == [(1, "c", 1, "x")]
    with pytest.raises(RuntimeError):
        put("e", "too late")
    with pytest.raises(RuntimeError):
        shards.add_shard(spark, root, "c")
    with pytest.raises(ValueError):
        shards.add_shard(spark, root, "../c")
