"""Mail that can't stop a job, mail files in any ranges, polls by messages, and the quarantine."""

import glob
import mailbox
import os
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowdex.session import work_dir
from flowdex.sinks.files import batch_sink
from flowdex.sources import mail
from flowdex.sources import mailbox as box
from flowdex.streaming.quarantine import fan_out, quarantine
from flowdex.streaming.runner import run_micro_batch


def checked(spark, raws):
    rows = spark.createDataFrame([(i, "inbox", None if r is None else bytearray(r)) for i, r in enumerate(raws)],
                                 mail.RAW_MAIL_SCHEMA)
    return [r for r in mail.check_mail(rows).orderBy("msg_no").collect()]


def test_bad_headers_and_charsets(spark):
    got = checked(spark, [
        b"Subject: =?utf-8?B?abcde?=\n\nx", "From: Jörg <jörg@b.example>\n\nx".encode(), b"Content-Type: text/plain; charset=idna\n\na.b",
        "From: Jörg <jorg@b.example>\nSubject: Größe\n\nx".encode(), "From: Jörg <j@b.example>\nSubject: Größe\n\nx".encode("latin-1"),
        b"Subject: =?utf-8?Q?caf=C3?= =?utf-8?Q?=A9?= and =?iso-8859-1?q?=E9?=\n =?utf-8?B?4pyT?= tail\n\nx",
        b'From: "A \\"B\\", C" <a@x.example>\n\nx', None, b"", b"Content-Type: multipart/mixed; boundary=b\n\nnothing",
        b"Content-Type: text/plain; charset=\"\0\"\n\nx"])
    assert got[0]["subject"] == "=?utf-8?B?abcde?=" and got[1]["from"] == "Jörg <jörg@b.example>"
    assert got[2]["content"][0]["content"] == "a.b" and got[3]["from"] == got[3]["from"] == "Jörg <jorg@b.example>"
    assert got[3]["subject"] == got[4]["subject"] == "Größe" and got[4]["from"] == "Jörg <j@b.example>"
    assert got[5]["subject"] == "café and é✓ tail" and got[6]["from"] == '"A \\"B\\", C" <a@x.example>'
    assert [r["error"] for r in got] == [None] * 7 + [mail.NULL_MESSAGE, mail.EMPTY_MESSAGE, mail.BROKEN_MULTIPART, None]


def test_mail_comes_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.unset(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    raw = spark.range(0, 2000, 1, 1).selectExpr("id as msg_no", "'f' as folder", "cast(repeat('x', 20000) as binary) as raw")
    try:
        emails = mail.check_mail(raw)
        assert max(r.n for r in raw.mapInArrow(sizes, "n long").collect()) < 8 << 20
        assert emails.where("length(content[0].content) = 20000").count() == 2000
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_no_bytes_stop_the_parser():
    rng = random.Random(11)
    words = [b"From:", b"Subject:", b"=?utf-8?B?", b"?=", b"Content-Type: multipart/mixed; boundary=", b"Content-Type: text/html; charset=",
             b"\r\n", b"\n\n", b"--x", b"Content-Transfer-Encoding: base64\n", b"idna", b"utf-7", b"unicode_escape", b"<a@b>", b'"', b"\\", b"=?hex?Q?=ZZ?="]
    for _ in range(3000):
        raw = b"".join(rng.choice(words) if rng.random() < 0.6 else bytes(rng.randrange(256) for _ in range(rng.randrange(9)))
                       for _ in range(rng.randrange(25)))
        sender, subject, parts, error = mail._checked(raw)
        for text in [sender, subject, error, *(p["content"] for p in parts)]:
            assert text is None or text.encode("utf-8") is not None
    deep = b"".join(b"Content-Type: multipart/mixed; boundary=b%d\n\n--b%d\n" % (i, i) for i in range(1500))
    error = mail._checked(deep)[3]
    assert error is None or "Error" in error


def test_quarantine_leaves_each_row_once(spark):
    base = work_dir(spark, "quarantine")
    rows = spark.createDataFrame([(1, None, b"a"), (2, "bad", b"b"), (3, None, b"c")], "msg_no int, error string, raw binary")
    failing = []

    def rejects(df, batch_id):
        if failing:
            raise RuntimeError("the second sink is down")
        batch_sink(f"{base}/rejects")(df, batch_id)

    sink = quarantine(batch_sink(f"{base}/good"), rejects)
    failing.append(1)
    with pytest.raises(RuntimeError):
        run_micro_batch(rows, 0, None, sink)
    failing.clear()
    for _ in range(2):
        run_micro_batch(rows, 0, None, sink)
    good = spark.read.parquet(f"{base}/good")
    assert good.columns == ["msg_no", "batch_id"] and sorted(r.msg_no for r in good.collect()) == [1, 3]
    bad = spark.read.parquet(f"{base}/rejects").collect()
    assert [(r.msg_no, r.error, bytes(r.raw), r.batch_id) for r in bad] == [(2, "bad", b"b", 0)]


def test_quarantine_keeps_the_evidence_of_rejects_alone(spark, monkeypatch):
    held = []
    monkeypatch.setattr("flowdex.streaming.quarantine.fan_out", lambda *routes: lambda batch, i: held.extend(batch.collect()))
    rows = spark.createDataFrame([(1, None, b"a"), (2, "bad", b"b")], "msg_no int, error string, raw binary")
    quarantine(None, None)(rows, 0)
    assert [(r.msg_no, r.error, r.raw) for r in held] == [(1, None, None), (2, "bad", b"b")]


def test_a_drop_is_read_in_small_splits(spark):
    key, drop = "spark.sql.files.maxPartitionBytes", work_dir(spark, "splits")
    spark.createDataFrame([], mail.RAW_MAIL_SCHEMA).write.parquet(drop)
    old = spark.conf.get(key)
    try:
        for given, used in (("134217728b", str(32 << 20)), ("1000", "1000")):
            spark.conf.set(key, given)
            mail.read_mail_drop(spark, drop)
            assert spark.conf.get(key) == used
    finally:
        spark.conf.set(key, old)


def test_a_stream_goes_on_after_bad_mail(spark):
    base = work_dir(spark, "bad_mail_stream")
    good = b"From: a@x.example\nSubject: s\n\nbody"
    sink = quarantine(batch_sink(f"{base}/good"), batch_sink(f"{base}/rejects"))
    for first in (0, 10):
        rows = [(first + i, "inbox", None if i == 3 else bytearray(good)) for i in range(6)]
        spark.createDataFrame(rows, mail.RAW_MAIL_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/drop")
        stream = mail.check_mail(mail.read_mail_drop(spark, f"{base}/drop"))
        query = (stream.writeStream.foreachBatch(lambda df, i: run_micro_batch(df, i, None, sink))
                 .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    kept = spark.read.parquet(f"{base}/good")
    assert sorted(r.msg_no for r in kept.collect()) == [0, 1, 2, 4, 5, 10, 11, 12, 14, 15]
    lost = spark.read.parquet(f"{base}/rejects").orderBy("msg_no").collect()
    assert [(r.msg_no, r.error, r.batch_id) for r in lost] == [(3, mail.NULL_MESSAGE, 0), (13, mail.NULL_MESSAGE, 1)]


def test_fan_out_may_repeat_rows(spark):
    seen = {}
    routes = [(F.col("id") % 2 == 0, "even"), (F.col("id") > 3, "large")]
    sink = fan_out(*[(p, lambda df, b, n=n: seen.setdefault(n, []).extend(r.id for r in df.collect())) for p, n in routes])
    sink(spark.range(6), 0)
    assert sorted(seen["even"]) == [0, 2, 4] and sorted(seen["large"]) == [4, 5]


BODIES = ["plain", "From the start\nFrom here\n>From there\n>>From deep", "x" * 5000, "two\n\nFrom a paragraph\n\nFro\nFr\nF", "8-bit é ✓", "", "\nFrom ",
          "a\n\n\nFrom three"]


@pytest.fixture(scope="module")
def boxes(spark):
    path = work_dir(spark, "mbox")
    rows = [(i, f"Subject: n{i}\n\n{BODIES[i % len(BODIES)]}".encode()) for i in range(200)]
    df = spark.createDataFrame([(i, bytearray(r)) for i, r in rows], "i int, raw binary")
    box.write_mbox(df.repartitionByRange(3, "i").sortWithinPartitions("i"), path)
    return path, dict(rows)


@pytest.mark.parametrize("size", [1500, 5001, 1 << 20])
def test_any_range_gives_the_same_messages(spark, boxes, size):
    path, rows = boxes
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = box.read_mbox(spark, path)
        got = sorted((r.file, r.block, r.seq, bytes(r.raw)) for r in found.collect())
        numbered = {r.msg_no: bytes(r.raw) for r in box.number_mails(found).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [rows[i].rstrip(b"\r\n") for i in range(200)]
    assert [g[-1] for g in got] == want and [numbered[i + 1] for i in range(200)] == want


def test_mbox_as_the_standard_library_reads_it(spark, boxes):
    path, rows = boxes
    files = sorted(glob.glob(path.replace("file:", "") + "/*.txt"))
    read = [m.get_payload() for f in files for m in mailbox.mbox(f, create=False)]
    got = box.number_mails(box.read_mbox(spark, path)).orderBy("msg_no").collect()
    assert len(read) == len(got) == 200
    for text, r in zip(read, got):
        ours = bytes(r.raw).partition(b"\n\n")[2].decode()
        # The library leaves quoted lines as they are, and takes 8-bit bodies for ASCII.
        assert re.sub(r"(?m)^>(>*From )", r"\1", text.rstrip("\n")) == ours or "é" in ours


def test_ranges_that_cut_the_separator(spark, tmp_path):
    rng = random.Random(1)
    bits = ["\n", "\n\n", "F", "Fr", "From", "\nFro", "x", "\r\n", "\n\nFrom", " "]
    texts = [re.sub(r"(?m)^From ", ">From ", f"m{i}\n" + "".join(rng.choices(bits, k=rng.randrange(20)))) for i in range(60)]
    (tmp_path / "box").write_bytes("".join(f"From x\n{t}\n\n" for t in texts).encode())
    want = [re.sub(r"(?m)^>(>*From )", r"\1", t).rstrip("\r\n") for t in texts]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (31, 64, 111):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = sorted((r.block, r.seq, bytes(r.raw).decode()) for r in box.read_mbox(spark, f"file:{tmp_path}/box").collect())
            assert [g[-1] for g in got] == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_crlf_boxes_and_mail_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.mbox").write_bytes(b"From x\r\nSubject: a\r\n\r\none\r\n\r\nFrom y\r\nSubject: b\r\n\r\ntwo\r\n")
    got = box.read_mbox(spark, f"file:{tmp_path}/in").collect()
    assert [bytes(r.raw) for r in got] == [b"Subject: a\r\n\r\none", b"Subject: b\r\n\r\ntwo"]
    (tmp_path / "m").mkdir()
    for i in range(3):
        (tmp_path / "m" / f"{i}.eml").write_bytes(b"Subject: s%d\n\nx" % i)
    (tmp_path / "m" / "note.txt").write_bytes(b"no mail")
    files = box.read_mail_files(spark, f"file:{tmp_path}/m").withColumn("msg_no", F.lit(1).cast("bigint")).withColumn("folder", F.lit("f"))
    assert sorted(r.subject for r in mail.flatten_mail(files).collect()) == ["s0", "s1", "s2"]


def test_polls_are_bounded_in_messages(spark):
    spark.conf.set("spark.sql.streaming.stopTimeout", "30s")
    base = work_dir(spark, "polls")

    def arrive(first, n):
        rows = [(first + i, "inbox", bytearray(b"Subject: s\n\nx")) for i in range(n)]
        spark.createDataFrame(rows, mail.RAW_MAIL_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/drop")

    polls = {}

    def run(most):
        """A query that dies in the sink of the poll after so many: that poll is planned, but not done."""
        def sink(df, batch_id):
            if len(polls) >= most:
                raise RuntimeError("stopped here")
            polls[batch_id] = sorted(r.msg_no for r in df.collect())

        stream = box.read_mail_polls(spark, f"{base}/drop", f"{base}/progress", per_partition=4)
        query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint")
                 .trigger(processingTime="0 seconds").start())
        try:
            query.processAllAvailable()
        except StreamingQueryException as e:
            assert "stopped here" in str(e)
        finally:
            query.stop()

    arrive(0, 25)
    run(2)
    assert [len(polls[i]) for i in sorted(polls)] == [10, 10]
    run(9)  # the third poll is run again
    assert [len(polls[i]) for i in sorted(polls)] == [10, 10, 5]
    arrive(25, 3)
    arrive(28, 9)
    run(9)  # nothing was open: the next poll begins where the last one ended
    assert [len(polls[i]) for i in sorted(polls)] == [10, 10, 5, 10, 2]
    assert sorted(m for p in polls.values() for m in p) == list(range(37))


def test_a_poll_reads_a_row_group_once(tmp_path):
    schema = pa.schema([("msg_no", pa.int64()), ("folder", pa.string()), ("raw", pa.binary())])
    for name, size in (("a", 100), ("b", 7)):
        table = pa.table([range(100), ["f"] * 100, [b"x"] * 100], schema=schema)
        pq.write_table(table, tmp_path / f"{name}.parquet", row_group_size=size)
        os.utime(tmp_path / f"{name}.parquet", (1, 1))
    reader = box._DropReader({"path": str(tmp_path), "progress": str(tmp_path / "p" / "progress"), "perPartition": "20"})
    plan = reader.partitions({"messages": 30}, {"messages": 160})
    assert [p.value[1:] for p in plan] == [(30, 100), (0, 14), (14, 28), (28, 42), (42, 60)]
    assert [[m for b in reader.read(p) for m in b["msg_no"].to_pylist()] for p in plan] == [list(range(*p.value[1:])) for p in plan]
