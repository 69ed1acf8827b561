"""Text/byte helpers shared by the feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_utf8(data: Column | str) -> Column:
    """Bytes -> text; malformed sequences become U+FFFD instead of failing the batch."""
    return F.make_valid_utf8(_col(data).cast("string"))


def encode_utf8(text: Column | str) -> Column:
    return F.encode(_col(text), "UTF-8")


def render_email_content(content: Column | str, msg_type: Column | str) -> Column:
    """Debug rendering of one mail part: ``EmailContent(<content> (...),<type>)``."""
    return F.format_string("EmailContent(%s (...),%s)", _col(content), _col(msg_type))
