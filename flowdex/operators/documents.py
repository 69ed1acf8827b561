"""Index document preparation: message text -> flat ``map<string,string>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.functions.documents import doc_size, mapify
from flowdex.session import ensure_map_policy


def prepare_documents(messages: DataFrame, value_col: str = "value", keep: Sequence[str] = (),
                      drop_empty: bool = False) -> DataFrame:
    """Every message becomes a document; unparsable text gives an empty one.

    Empty documents are still written by default, as upstream; ``drop_empty``
    removes them.
    """
    ensure_map_policy(messages.sparkSession)
    docs = messages.select(*keep, mapify(value_col).alias("doc"))
    if drop_empty:
        docs = docs.where(doc_size("doc") > 0)
    return docs


def doc_fields(docs: DataFrame, fields: Sequence[str], keep: Sequence[str] = (),
               doc_col: str = "doc") -> DataFrame:
    """Project named document keys to columns (missing key -> NULL)."""
    return docs.select(*keep, *[F.try_element_at(F.col(doc_col), F.lit(f)).alias(f) for f in fields])
