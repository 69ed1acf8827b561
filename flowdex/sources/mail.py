"""Mail feed: raw RFC 822 messages -> ``Email`` rows.

The reference polls a mailbox from one receiver thread.  Here raw messages land
as rows / files in a mail drop; a file stream replaces the poll loop (its source
offset replaces the "already read" counter) and parsing runs partition-parallel
in ``mapInPandas`` with the standard library's ``email`` parser.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.operators import paging

# The parser runs in Python workers, which may not have this package on their
# path (it need not be installed on executors): ship this module's functions by
# value with each task instead of by import name.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: rely on imports
    pass

# The two MIME types an email part can have, the texts used for a
# missing / empty sender list, and the folder that is read by default.
TEXT_PLAIN = "TEXT/PLAIN"
TEXT_HTML = "TEXT/HTML"
SENDER_NULL = "Null"
SENDER_EMPTY = "Empty"
DEFAULT_FOLDER = "inbox"

RAW_MAIL_SCHEMA = "msg_no bigint, folder string, raw binary"
EMAIL_SCHEMA = ("msg_no bigint, folder string, `from` string, subject string, "
                "content array<struct<content: string, msgType: string>>")

# What is said of messages that can't be read whole.
NULL_MESSAGE = "null message"
EMPTY_MESSAGE = "empty message"
BROKEN_MULTIPART = "multipart without parts"
ERROR_CHARS = 500

# Whole messages are held several times over by a task that parses them: bounds on what one holds at a time.
BATCH_BYTES, BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
SPLIT_BYTES, SPLIT_LIMIT = "spark.sql.files.maxPartitionBytes", 32 << 20

# Poll constants of the reference's receiver: 10 messages every 2 seconds.
POLL_BATCH = 10
POLL_INTERVAL = "2 seconds"


def mail_batches(mails: DataFrame) -> DataFrame:
    """``mails``, after setting its session to Arrow batches of a few megabytes, where the session doesn't name a size.

    A batch of Spark's default size (64 MB) is in its Python worker as bytes, as objects, parsed, and as what goes back.
    """
    conf = mails.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, BATCH_LIMIT)
    return mails


def mail_splits(spark: SparkSession) -> SparkSession:
    """The session, after bounding the bytes of files that one of its tasks reads, where the session doesn't.

    Messages are texts: what a task holds of them unpacked is many times what it reads.
    """
    if spark.conf.get(SPLIT_BYTES, None) in (None, "134217728b"):
        spark.conf.set(SPLIT_BYTES, str(SPLIT_LIMIT))
    return spark


def render_sender(from_col: Column | str) -> Column:
    """Sender list -> text: NULL -> ``Null``, empty -> ``Empty``, else comma-joined."""
    c = F.col(from_col) if isinstance(from_col, str) else from_col
    return (F.when(c.isNull(), F.lit(SENDER_NULL))
            .when(F.size(c) == 0, F.lit(SENDER_EMPTY))
            .otherwise(F.array_join(c, ",")))


def mail_page(mails: DataFrame, take: int | None = None, drop: int = 0,
              folder: str | None = DEFAULT_FOLDER, order_col: str = "msg_no",
              keys: DataFrame | None = None, bucket_rows: int = paging.BUCKET_ROWS) -> DataFrame:
    """``drop`` then ``take`` messages of a folder in mailbox order (of all folders with ``folder=None``).

    ``keys``: a cheaper table with the message numbers of the box (see :func:`paging.page`).
    """
    if folder is not None:
        mails = mails.where(F.col("folder") == folder)
        keys = None if keys is None else keys.where(F.col("folder") == folder)
    return paging.page(mails, order_col, drop, take, keys, bucket_rows)


def _part_type(part) -> str | None:
    """HTML or plain text by the part's effective type: a part without ``Content-Type`` is plain text."""
    kind = part.get_content_type()
    if kind == "text/html":
        return TEXT_HTML
    if kind == "text/plain":
        return TEXT_PLAIN
    return None


def _text_of(part) -> str:
    payload = part.get_payload(decode=True)
    if payload is None:
        return ""
    charset = part.get_content_charset() or "utf-8"
    try:
        return payload.decode(charset, errors="replace")
    except (LookupError, ValueError):  # unknown charset, or a codec that isn't one for mail
        return payload.decode("utf-8", errors="replace")


ENCODED_WORD = re.compile(r"=\?([^?\s]*)\?([bBqQ])\?([^?]*)\?=")


def _raw_headers(msg, name: str) -> list[str]:
    """Values of a header from its bytes (UTF-8, else Latin-1), folded lines joined; encoded words are left as they are."""
    out = []
    for key, value in msg.raw_items():
        if key.lower() == name:
            data = str(value).encode("utf-8", "surrogateescape")
            try:
                text = data.decode("utf-8")
            except UnicodeDecodeError:
                text = data.decode("latin-1")
            out.append(" ".join(text.split()))
    return out


def _word_bytes(way: str, payload: str) -> bytes:
    import binascii

    if way in "bB":
        return binascii.a2b_base64(payload + "=" * (-len(payload) % 4))
    return binascii.a2b_qp(payload.encode("utf-8"), header=True)


def _header(text: str) -> str:
    """Header text with its encoded words decoded; a word that can't be decoded stays as it came."""
    out, at, held, charset = [], 0, b"", None

    def flush():
        nonlocal held, charset
        if charset is not None:
            out.append(held.decode(charset, errors="replace"))
        held, charset = b"", None

    for m in ENCODED_WORD.finditer(text):
        between = text[at:m.start()]
        try:
            name = m[1].partition("*")[0].lower()
            data = _word_bytes(m[2], m[3])
            data.decode(name, errors="replace")
        except (LookupError, ValueError):
            flush()
            out.append(between + m[0])
        else:
            if charset is None or between.strip():
                flush()
                out.append(between)
            elif charset != name:  # white space between encoded words isn't text
                flush()
            held, charset = held + data, name
        at = m.end()
    flush()
    return "".join(out) + text[at:]


NAME_SPECIALS = re.compile(r'[][\\()<>@,:;".]')


def _address(name: str, addr: str) -> str:
    """Display name and address as the mail API prints them, whatever characters they hold."""
    if not name:
        return addr
    quote = '"' if NAME_SPECIALS.search(name) else ""
    escaped = name.replace("\\", "\\\\").replace('"', '\\"')
    return f"{quote}{escaped}{quote} <{addr}>"


def _parse_one(raw: bytes | None):
    import email
    from email.utils import getaddresses

    msg = email.message_from_bytes(bytes(raw or b""))
    senders = _raw_headers(msg, "from")
    if not senders:
        sender = SENDER_NULL
    else:
        # Whole addresses, display name included.
        addrs = [_address(name, addr) for name, addr in getaddresses(senders) if addr]
        sender = ",".join(addrs) if addrs else SENDER_EMPTY
    parts = []
    if msg.is_multipart():
        # One level only: each top-level part that is HTML or plain text.
        for part in msg.get_payload():
            kind = _part_type(part)
            if kind is not None:
                parts.append({"content": _text_of(part), "msgType": kind})
    else:
        kind = TEXT_HTML if _part_type(msg) == TEXT_HTML else TEXT_PLAIN
        parts.append({"content": _text_of(msg), "msgType": kind})
    subject = _raw_headers(msg, "subject")
    broken = BROKEN_MULTIPART if msg.get_content_maintype() == "multipart" and not msg.is_multipart() else None
    return sender, _header(subject[0]) if subject else None, parts, broken


def _checked(raw: bytes | None):
    """A parsed message and what is wrong with it: nothing that a message holds stops the task."""
    try:
        sender, subject, parts, broken = _parse_one(raw)
    except Exception as e:  # the standard parser's own failures; their kind depends on the message
        return None, None, [], f"{type(e).__name__}: {e}"[:ERROR_CHARS]
    if raw is None:
        broken = NULL_MESSAGE
    elif not raw:
        broken = EMPTY_MESSAGE
    # Text that no reader could decode again (lone surrogates of a charset) isn't passed on.
    clean = [None if x is None else x.encode("utf-8", "replace").decode("utf-8") for x in (sender, subject)]
    parts = [{**p, "content": p["content"].encode("utf-8", "replace").decode("utf-8")} for p in parts]
    return clean[0], clean[1], parts, broken


def _flatten_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        parsed = [_checked(None if r is None else bytes(r)) for r in pdf["raw"]]
        yield pd.DataFrame({
            "msg_no": pdf["msg_no"],
            "folder": pdf["folder"],
            "from": [p[0] for p in parsed],
            "subject": [p[1] for p in parsed],
            "content": [p[2] for p in parsed],
            "error": [p[3] for p in parsed],
            "raw": pdf["raw"],
        })


def check_mail(raw: DataFrame) -> DataFrame:
    """Raw messages ``(msg_no, folder, raw)`` -> ``Email`` rows with ``error`` and ``raw`` (works on streams).

    ``error`` is null for a message that was read whole; else it says why not: a null or empty message, a multipart
    message without parts, or the parser's own failure.  No message stops the job.
    """
    return mail_batches(raw).select("msg_no", "folder", "raw").mapInPandas(_flatten_batches, EMAIL_SCHEMA + ", error string, raw binary")


def flatten_mail(raw: DataFrame) -> DataFrame:
    """Raw messages ``(msg_no, folder, raw)`` -> ``Email`` rows (works on streams).

    What can't be read of a message is missing from its row (see :func:`check_mail` for the reasons).
    """
    return check_mail(raw).drop("error", "raw")


def explode_content(emails: DataFrame) -> DataFrame:
    """One row per body part: ``msg_no, pos, msg_type, content``."""
    return emails.select(
        "msg_no", F.posexplode("content").alias("pos", "_c")
    ).select("msg_no", F.col("pos").cast("bigint").alias("pos"),
             F.col("_c.msgType").alias("msg_type"), F.col("_c.content").alias("content"))


def poll_trigger() -> dict:
    """The reference's poll cadence as a Structured Streaming trigger."""
    return {"processingTime": POLL_INTERVAL}


def read_mail_drop(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the mail drop folder (parquet files of raw messages).

    A poll takes every file that is there; ``files_per_trigger`` bounds it for a backlog that must be cut into batches
    (the reference's poll took ``POLL_BATCH`` messages, which is a bound on rows that files don't have).
    """
    reader = mail_splits(spark).readStream.schema(RAW_MAIL_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)
