"""Feed shapes derived from the driver's parquet tables.

The reference reads live feeds (brokers, sockets, a mailbox).  For batch runs,
tests and the benchmark, the same shapes are derived from the tables with plain
DataFrame expressions, so the work grows with the tables:

* ``log_messages``   events -> JSON log lines ``{"host","path","lineno"}`` + ``batch`` (day)
* ``keyed_records``  documents -> (topic, key, value) byte records
* ``frame_messages`` conversations -> two-frame messages ``[role, text]``
* ``interactions`` / ``status_feed``  events -> interaction JSON / status rows
* ``raw_mail`` / ``mail_senders``  documents + pages / supplier + nation -> mail
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.functions.text import encode_utf8

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shard_sources(spark: SparkSession, sf_dir: str, name: str, columns: list[str],
                  shards: int, key: str | None = None) -> list[DataFrame]:
    """``shards`` independent sources that together hold the table once.

    A shard is the rows whose hash of ``key`` (default: the first column) falls
    to it: nothing is copied, no file list is made, partition columns are columns
    like others, and a null key has its shard too.
    """
    full = table(spark, sf_dir, name).select(*columns)
    slot = F.pmod(F.xxhash64(key or columns[0]), F.lit(shards))
    return [full.where(slot == i) for i in range(shards)]


# The two log files of the reference's report query.
SYSTEM_LOG = "/var/log/system.log"
AUTH_LOG = "/var/log/auth.log"


def log_messages(events: DataFrame, host: str = "event_type", with_id_in_text: bool = False) -> DataFrame:
    """events -> ``(event_id, batch, value)`` where ``value`` is a JSON log line.

    ``host`` is ``event_type`` or ``user_id`` (as text); ``path`` alternates by
    parity of ``event_id``; ``lineno`` is ``props.k``; the micro-batch is the day.
    """
    host_col = F.col(host).cast("string").alias("host")
    path_col = F.when(F.col("event_id") % 2 == 0, F.lit(SYSTEM_LOG)).otherwise(F.lit(AUTH_LOG)).alias("path")
    lineno_col = F.get_json_object("props", "$.k").cast("bigint").alias("lineno")
    fields = [host_col, path_col, lineno_col]
    if with_id_in_text:
        fields = [F.col("event_id")] + fields
    return events.select(
        "event_id",
        F.to_date("ts").alias("batch"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


# The days (from the table's first one) on which the drifting log changes.
DRIFT = {"score": 10, "decimal": 14, "double": 18, "zone": 20, "text": 24}


def drifting_messages(events: DataFrame) -> DataFrame:
    """events -> ``(batch, value)``: a log whose objects change over the days.

    ``score`` comes on day 10 as a whole number, and only on even days; it has a decimal point from day 14 on and an exponent
    on every sixth day from day 18 on.  ``zone`` comes on day 20, in every tenth object, which also repeats its ``host``.
    ``lineno`` is quoted on every sixth day from day 24 on.
    """
    first = events.agg(F.min(F.to_date("ts"))).first()[0]  # one value
    if first is None:
        return events.select(F.to_date("ts").alias("batch"), F.lit(None).cast("string").alias("value"))
    day = F.datediff(F.to_date("ts"), F.lit(first))
    k = F.get_json_object("props", "$.k")
    quoted = (day >= DRIFT["text"]) & (day % 6 == 0)
    score = (F.when((day < DRIFT["score"]) | (day % 2 == 1), "")
             .when((day >= DRIFT["double"]) & (day % 6 == 0), F.concat(F.lit(',"score":'), k, F.lit(".5e0")))
             .when(day >= DRIFT["decimal"], F.concat(F.lit(',"score":'), k, F.lit(".5")))
             .otherwise(F.concat(F.lit(',"score":'), k)))
    zoned = (day >= DRIFT["zone"]) & (F.col("event_id") % 10 == 0)
    zone = F.when(zoned, F.concat(F.lit(',"zone":{"id":'), (F.col("event_id") % 3).cast("string"),
                                  F.lit('},"host":"again"'))).otherwise("")
    return events.select(
        F.to_date("ts").alias("batch"),
        F.concat(F.lit('{"host":"'), F.col("event_type"), F.lit('","lineno":'),
                 F.when(quoted, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k), score, zone, F.lit("}")).alias("value"))


def resharded(events: DataFrame) -> DataFrame:
    """events -> ``(event_id, event_type, phase, shard)``: shards by id and phase (ten days each, the last one the rest).

    Shard ``a`` (even ids) becomes ``a0`` and ``a2`` after the first phase; ``a2`` and ``b`` (odd ids) become ``m`` after the second.
    """
    first = events.agg(F.min(F.to_date("ts"))).first()[0]  # one value
    day, four = F.datediff(F.to_date("ts"), F.lit(first).cast("date")), F.col("event_id") % 4
    phase = F.when(day < 10, 0).when(day < 20, 1).otherwise(2)
    shard = (F.when(phase == 0, F.when(four % 2 == 0, "a").otherwise("b")).when(four == 0, "a0")
             .when(phase == 2, "m").otherwise(F.when(four == 2, "a2").otherwise("b")))
    return events.select("event_id", "event_type", phase.alias("phase"), shard.alias("shard"))


def keyed_records(documents: DataFrame) -> DataFrame:
    """documents -> broker-style records: ``topic`` = source, key/value as bytes."""
    return documents.select(
        "doc_id",
        F.col("source").alias("topic"),
        encode_utf8(F.col("doc_id").cast("string")).alias("key"),
        encode_utf8("text").alias("value"),
    )


def frame_messages(conversations: DataFrame) -> DataFrame:
    """conversations -> one two-frame message per turn: ``[role, text]`` (role = topic)."""
    return conversations.select(
        "conv_id", "turn",
        F.array(encode_utf8("role"), encode_utf8("text")).alias("frames"),
    )


def interactions(events: DataFrame) -> DataFrame:
    """events -> interactions; ``error`` events play the vendor's delete notices."""
    return events.select(
        "event_id",
        (F.col("event_type") == "error").alias("is_delete"),
        F.to_json(F.struct("event_id", "event_type", "value")).alias("interaction"),
    )


def status_feed(events: DataFrame) -> DataFrame:
    """events -> vendor status messages: error -> error, view -> info, rest warning."""
    return events.select(
        "event_id",
        (F.col("event_type") == "error").alias("is_error"),
        (F.col("event_type") == "view").alias("is_info"),
        F.col("props").alias("message"),
    )


def mail_senders(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One message per supplier, sent from the supplier and its nation's desk.

    Every tenth message has no sender list, and the one after it an empty list.
    ``nation`` has a fixed 25 rows (TPC-H), so the planner's size check makes it
    a broadcast side; nothing else is assumed about it.
    """
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
    listed = F.filter(F.array("s_name", "n_name"), lambda x: x.isNotNull())
    tenth = F.col("s_suppkey") % 10
    return joined.select(
        F.col("s_suppkey").alias("msg_no"),
        F.when(tenth == 0, F.lit(None)).when(tenth == 1, F.array().cast("array<string>")).otherwise(listed).alias("from"),
    )


BOUNDARY = "=_flowdex_part"


def _bytes(*parts) -> F.Column:
    return F.concat(*[encode_utf8(p if isinstance(p, F.Column) else F.lit(p)) for p in parts])


def _quoted_printable(body) -> F.Column:
    every = F.regexp_replace(F.hex(encode_utf8(body)), "(..)", "=$1")
    return F.regexp_replace(every, "((?:=..){24})", "$1=\r\n")  # soft line ends


def _body(headers: str, body, way: int) -> F.Column:
    """Bytes of one part: 8-bit (way 0), base64 (1) or quoted-printable (2)."""
    if way == 0:
        return _bytes(f"{headers}Content-Transfer-Encoding: 8bit\r\n\r\n", F.col(body))
    if way == 1:
        return _bytes(f"{headers}Content-Transfer-Encoding: base64\r\n\r\n", F.base64(encode_utf8(body)))
    return _bytes(f"{headers}Content-Transfer-Encoding: quoted-printable\r\n\r\n", _quoted_printable(body))


def raw_mail(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """documents (+ the page with the same id) -> RFC 822 messages as bytes.

    A document with a page becomes a two-part ``multipart/alternative`` mail
    (plain text, then HTML); one without a page a single-part plain mail.  The
    id chooses the body's transfer encoding (8-bit, base64, quoted-printable),
    whether the plain part names its type at all, whether the subject is an
    encoded word, and whether the sender has a display name.
    """
    joined = documents.join(pages, documents.doc_id == pages.page_id, "left")
    doc = F.col("doc_id")
    number = doc.cast("string")
    sender = F.when(doc % 3 == 0, F.concat(F.lit("Feed "), F.col("source"), F.lit(" <"), F.col("source"),
                                           F.lit("@feed.example>"))).otherwise(
        F.concat(F.col("source"), F.lit("@feed.example")))
    encoded = F.concat(F.lit("=?utf-8?B?"), F.base64(encode_utf8(F.concat(F.lit("Größe "), number))), F.lit("?="))
    subject = F.when(doc % 4 == 0, encoded).otherwise(F.concat(F.lit("document "), number))
    headers = F.concat(F.lit("From: "), sender, F.lit("\r\nSubject: "), subject, F.lit("\r\nMIME-Version: 1.0\r\n"))
    typed, html = "Content-Type: text/plain; charset=utf-8\r\n", "Content-Type: text/html; charset=utf-8\r\n"

    def by_id(make):
        chosen = F.when(doc % 15 == 0, make("", 0)).when(doc % 15 == 5, make("", 1)).when(doc % 15 == 10, make("", 2))
        return chosen.when(doc % 3 == 0, make(typed, 0)).when(doc % 3 == 1, make(typed, 1)).otherwise(make(typed, 2))

    plain = by_id(lambda kind, way: _body(kind, "text", way))
    rich = F.when(doc % 2 == 0, _body(html, "html", 0)).otherwise(_body(html, "html", 2))
    opened, closed = f"--{BOUNDARY}\r\n", f"\r\n--{BOUNDARY}--\r\n"
    multipart = F.concat(
        encode_utf8(headers), _bytes(f'Content-Type: multipart/alternative; boundary="{BOUNDARY}"\r\n\r\n{opened}'),
        plain, _bytes(f"\r\n{opened}"), rich, _bytes(closed))
    return joined.select(
        doc.alias("msg_no"), F.col("source").alias("folder"),
        F.when(F.col("page_id").isNotNull(), multipart).otherwise(F.concat(encode_utf8(headers), plain)).alias("raw"))


def odd_mail(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """:func:`raw_mail` with a quarter of the messages as ordinary bad mail, by id.

    Of twenty: one is null, one a multipart without its parts, one has 8-bit headers in UTF-8, one in Latin-1, and one an
    encoded word and a charset that can't be decoded.  The first two can't be read; the others can.
    """
    mails = raw_mail(documents, pages)
    kind = F.col("msg_no") % 20
    number = F.col("msg_no").cast("string")
    body = _bytes("\r\nMIME-Version: 1.0\r\nContent-Type: text/plain; charset=idna\r\n\r\nbody ", number)

    def with_headers(sender: str, subject: str, charset: str):
        return F.concat(F.encode(F.concat(F.lit(f"From: {sender}\r\nSubject: {subject} "), number), charset), body)

    hollow = _bytes("From: a@feed.example\r\nContent-Type: multipart/mixed; boundary=gone\r\n\r\nno part ", number)
    raw = (F.when(kind == 3, F.lit(None).cast("binary")).when(kind == 8, hollow)
           .when(kind == 13, with_headers("Jörg <jorg@feed.example>", "Größe", "UTF-8"))
           .when(kind == 1, with_headers("Jörg <jörg@feed.example>", "Größe", "ISO-8859-1"))
           .when(kind == 18, with_headers("a@feed.example", "=?utf-8?B?abcde?=", "UTF-8")).otherwise(F.col("raw")))
    return mails.select("msg_no", "folder", raw.alias("raw"))
