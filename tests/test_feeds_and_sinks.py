"""Feed operators on hand-written rows; Kafka / index option builders (no broker)."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowdex.sinks import index as index_sink
from flowdex.sinks import kafka as kafka_sink
from flowdex.sources import feeds, mail


def test_topic_list_and_pattern():
    assert feeds.parse_topic_list(" a, b,,c ") == ["a", "b", "c"]
    assert feeds.whitelist_regex("t1,t2") == "^(?:t1|t2)$"


def test_kafka_source_options():
    opts = feeds.kafka_source_options("h:9092", topics="a, b", group="g", timeout_ms=500,
                                      min_partitions=8, max_offsets=1000)
    assert opts == {"kafka.bootstrap.servers": "h:9092", "startingOffsets": "earliest",
                    "subscribe": "a,b", "kafka.group.id": "g",
                    "kafkaConsumer.pollTimeoutMs": "500", "minPartitions": "8",
                    "maxOffsetsPerTrigger": "1000"}
    pat = feeds.kafka_source_options("h:9092", pattern="logs.*", from_start=False)
    assert pat["subscribePattern"] == "(?:logs.*)" and pat["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        feeds.kafka_source_options("h:9092")


def test_kafka_sink_options_and_records(spark):
    assert kafka_sink.sink_options("b:9092", "out") == {
        "kafka.bootstrap.servers": "b:9092", "kafka.acks": "all", "kafka.retries": "3",
        "kafka.compression.type": "gzip", "topic": "out"}
    with pytest.raises(ValueError):
        kafka_sink.sink_options("")
    df = spark.createDataFrame([("v1",)], "text string")
    rec = kafka_sink.records(df, "text", topic="t").first()
    assert rec["key"] is None and bytes(rec["value"]) == b"v1" and rec["topic"] == "t"


def test_index_options_and_connector_documents(spark):
    assert index_sink.index_options("es1,es2", 9200, "logs", "message", id_col="id") == {
        "es.nodes": "es1,es2", "es.port": "9200", "es.resource": "logs/message", "es.mapping.id": "id"}
    docs = spark.createDataFrame([(7, {"a": "x"}), (8, {"b": "y", "id": "z"})], "id bigint, doc map<string,string>")
    rows = index_sink.connector_documents(docs, id_col="id").orderBy("id").collect()
    assert [r.asDict() for r in rows] == [{"id": "7", "a": "x", "b": None}, {"id": "8", "a": None, "b": "y"}]
    assert index_sink.connector_documents(docs, fields=["a"]).columns == ["a"]


def test_binary_keys_stay_as_they_are(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\xff\xfe"), "v")], "k binary, v string")
    assert bytes(kafka_sink.records(df, "v", key_col="k", topic="t").first()["key"]) == b"\x00\xff\xfe"


def test_subscriptions(spark):
    df = spark.createDataFrame([("src1",), ("src12",), ("src2",), ("x",)], "topic string")
    assert feeds.subscribe_topics(df, "src1,x").count() == 2
    assert feeds.subscribe_pattern(df, "src1[0-9]?").count() == 2
    assert feeds.subscribe_prefix(df, "src1").count() == 2
    assert feeds.subscribe_prefix(df, "").count() == 4


def test_frames_and_shards(spark):
    df = spark.createDataFrame([(1, [bytearray(b"t"), bytearray(b"body")])], "id int, frames array<binary>")
    rows = feeds.flatten_frames(df, keep=["id"]).orderBy("pos").collect()
    assert [(r["pos"], r["value"]) for r in rows] == [(0, "t"), (1, "body")]
    a = spark.createDataFrame([(1,)], "x int")
    assert feeds.union_shards([a, a, a]).count() == 3


def test_interaction_feed_and_status(spark):
    rows = [(1, False, '{"event_id":1,"event_type":"view","value":60.0}'),
            (2, True, '{"event_id":2,"event_type":"error","value":70.0}'),
            (3, False, '{"event_id":3,"event_type":"click","value":10.0}')]
    df = spark.createDataFrame(rows, "event_id bigint, is_delete boolean, interaction string")
    obs = Observation("deletes")
    out = feeds.interaction_feed(df, query="value > 50 AND event_type <> 'x'", keep=["event_id"],
                                 observation=obs).collect()
    assert [r["event_id"] for r in out] == [1]
    assert obs.get == {"deleted": 1}
    st = spark.createDataFrame([(True, False, "m"), (False, True, "m"), (False, False, "m"), (True, False, None)],
                               "is_error boolean, is_info boolean, message string")
    assert [r[0] for r in feeds.status_messages(st).collect()] == ["Error:\nm", "Info:\nm", "Warning:\nm", "Error:\n"]


RAW_MULTI = ("From: Joe Doe <a@x.example>, b@y.example\r\nSubject: =?iso-8859-1?Q?caf=E9?=\r\n =?utf-8?B?5pel5pys?=\r\n"
             'MIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="B"\r\n\r\n'
             "--B\r\nContent-Type: TEXT/HTML; charset=utf-8\r\n\r\n<p>h</p>\r\n"
             "--B\r\nContent-Type: image/png\r\n\r\nxx\r\n"
             "--B\r\n\r\nno type\r\n"
             "--B\r\nContent-Type: text/plain; charset=iso-8859-1\r\nContent-Transfer-Encoding: quoted-printable\r\n\r\n"
             "caf=E9=\r\n!\r\n--B--\r\n").encode()
RAW_HTML = b"Subject: only\r\nContent-Type: text/html\r\n\r\n<b>x</b>"
RAW_NOFROM_TYPE = b"From: \r\nSubject: none\r\n\r\njust text"
RAW_8BIT = ("From: \"Doe, Joe\" <j@x.example>\r\nContent-Type: text/plain; charset=utf-8\r\n"
            "Content-Transfer-Encoding: 8bit\r\n\r\ncafé 日本\n").encode()
RAW_BAD = b"Subject: =?none-such?B?eA==?=\r\nContent-Type: text/plain; charset=none-such\r\n\r\n\xff caf\xc3\xa9"


def test_mail_flatten(spark):
    raw = spark.createDataFrame([(1, "inbox", RAW_MULTI), (2, "inbox", RAW_HTML), (3, "inbox", RAW_NOFROM_TYPE),
                                 (4, "inbox", RAW_8BIT), (5, "inbox", RAW_BAD), (6, "inbox", None)],
                                mail.RAW_MAIL_SCHEMA)
    emails = {r["msg_no"]: r for r in mail.flatten_mail(raw).collect()}
    assert emails[1]["from"] == "Joe Doe <a@x.example>,b@y.example" and emails[1]["subject"] == "café日本"
    assert [(c["msgType"], c["content"].strip()) for c in emails[1]["content"]] == [
        ("TEXT/HTML", "<p>h</p>"), ("TEXT/PLAIN", "no type"), ("TEXT/PLAIN", "café!")]
    assert emails[2]["from"] == "Null" and emails[2]["content"][0]["msgType"] == "TEXT/HTML"
    assert emails[3]["from"] == "Empty" and emails[3]["content"][0]["msgType"] == "TEXT/PLAIN"
    assert emails[4]["from"] == '"Doe, Joe" <j@x.example>' and emails[4]["content"][0]["content"] == "café 日本\n"
    assert emails[5]["subject"] == "=?none-such?B?eA==?=" and emails[5]["content"][0]["content"] == "\ufffd café"
    assert emails[6]["from"] == "Null" and emails[6]["subject"] is None and emails[6]["content"][0]["content"] == ""


def test_sender_rendering_and_page(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a", "b"])], "msg_no int, `from` array<string>")
    assert [r[0] for r in df.orderBy("msg_no").select(mail.render_sender("from")).collect()] == [
        "Null", "Empty", "a,b"]
    mails = spark.range(100).select(F.col("id").alias("msg_no"), F.lit("inbox").alias("folder"))
    assert [r["msg_no"] for r in mail.mail_page(mails, take=3, drop=5).collect()] == [5, 6, 7]
    assert mail.mail_page(mails, folder="other").count() == 0


def test_feed_openers_batch_and_stream(spark):
    from flowdex.session import work_dir
    base = work_dir(spark, "openers")
    for i in range(2):
        spark.createDataFrame([(bytearray(f"m{i}".encode()),)], "value binary").write.parquet(f"{base}/shard{i}")
    shard_paths = [f"{base}/shard0", f"{base}/shard1"]
    assert sorted(r["value"] for r in feeds.open_shard_feed(spark, shard_paths, streaming=False).collect()) == ["m0", "m1"]
    frames = spark.createDataFrame([([bytearray(b"logs"), bytearray(b"a")],), ([bytearray(b"other"), bytearray(b"b")],)],
                                   "frames array<binary>")
    frames.write.parquet(f"{base}/frames")
    got = feeds.open_frame_feed(spark, f"{base}/frames", topic="lo", streaming=False).collect()
    assert sorted((r["pos"], r["value"]) for r in got) == [(0, "logs"), (1, "a")]
    inter = spark.createDataFrame([(False, '{"event_id":1,"event_type":"v","value":9.0}'),
                                   (True, '{"event_id":2,"event_type":"e","value":9.0}')],
                                  "is_delete boolean, interaction string")
    inter.write.parquet(f"{base}/inter")
    q = (feeds.open_interaction_feed(spark, f"{base}/inter", query="value > 1").writeStream
         .format("memory").queryName("inter_feed").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r["value"] for r in spark.sql("select value from inter_feed").collect()] == [
        '{"event_id":1,"event_type":"v","value":9.0}']


def test_trigger_from_batch_duration(spark):
    from flowdex.streaming.runner import trigger_of
    assert trigger_of(available_now=True) == {"availableNow": True}
    assert trigger_of(0) == {"processingTime": "0 seconds"} and trigger_of() == {"processingTime": "5 seconds"}
    assert trigger_of(2) == {"processingTime": "2 seconds"}
    spark.conf.set("spark.batch.duration", "3")
    try:
        assert trigger_of(spark=spark) == {"processingTime": "3.0 seconds"}
    finally:
        spark.conf.unset("spark.batch.duration")


def test_record_id_and_poll_trigger(spark):
    df = spark.createDataFrame([("t", 3, 42)], "topic string, partition int, offset bigint")
    assert df.select(feeds.record_id()).first()[0] == "t:3:42"
    records = df.withColumn("value", F.lit(b"m"))
    assert feeds.identified_values(records).first().asDict() == {"record_id": "t:3:42", "value": "m"}
    assert mail.poll_trigger() == {"processingTime": "2 seconds"}


def test_shard_sources_keep_every_column(spark):
    from flowdex.session import work_dir
    from flowdex.sources.tables import shard_sources
    base = work_dir(spark, "shardsrc")
    (spark.range(100).selectExpr("if(id = 5, null, id) as k", "id % 7 as v", "id % 3 as day")
     .write.partitionBy("day").parquet(f"{base}/t.parquet"))
    for shards in (1, 3, 64):
        parts = shard_sources(spark, base, "t", ["k", "v", "day"], shards)
        rows = feeds.union_shards(parts).collect()
        assert len(parts) == shards
        assert sorted(map(str, map(tuple, rows))) == sorted(str((None if i == 5 else i, i % 7, i % 3)) for i in range(100))


def test_batch_sink_rewrite_is_idempotent(spark):
    from flowdex.session import work_dir
    from flowdex.sinks.files import write_batch
    out = work_dir(spark, "sinkidem")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    write_batch(df, out, 0)
    write_batch(df, out, 1)
    write_batch(df, out, 1)  # the replayed batch replaces its own folder only
    rows = sorted((r["batch_id"], r["x"]) for r in spark.read.parquet(out).collect())
    assert rows == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_files_per_trigger_cuts_a_backlog(spark):
    from flowdex.session import work_dir
    base = work_dir(spark, "backlog")
    for i in range(3):
        spark.createDataFrame([(bytearray(b"m%d" % i),)], "value binary").coalesce(1).write.mode("append").parquet(f"{base}/in")
    sizes = []
    q = (feeds.open_shard_feed(spark, [f"{base}/in"], files_per_trigger=1).writeStream
         .foreachBatch(lambda df, b: sizes.append(df.count())).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sizes == [1, 1, 1]
