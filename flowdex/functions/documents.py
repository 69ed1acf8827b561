"""Column functions for message documents (JSON text <-> flat string maps).

Everything here is a Catalyst expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three keys the histogram analyzer adds to every counted
# message, in the order they are appended to the document.
HISTO_FIELD = "histo_field"
HISTO_VALU = "histo_valu"
HISTO_SUPP = "histo_supp"

DOC_TYPE = "map<string,string>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_doc() -> Column:
    return F.create_map().cast(DOC_TYPE)


def mapify(value: Column | str) -> Column:
    """JSON text -> ``map<string,string>``.

    * invalid JSON, a top-level array, a scalar or NULL -> empty map;
    * numbers, booleans and nested objects/arrays become their JSON text;
    * members whose value is JSON null are dropped;
    * duplicate keys: the last one wins (needs ``mapKeyDedupPolicy=LAST_WIN``,
      set by :func:`flowdex.session.configure`).
    """
    parsed = F.coalesce(F.from_json(_col(value), DOC_TYPE), empty_doc())
    # Rebuilding the map from its entries collapses duplicate keys.
    deduped = F.map_from_entries(F.map_entries(parsed))
    return F.map_filter(deduped, lambda k, v: v.isNotNull())


def field_value(doc: Column | str, field: str) -> Column:
    """``m(field)``; NULL when the key is absent (the message is then not counted)."""
    return F.try_element_at(_col(doc), F.lit(field))


def merge_docs(left: Column | str, right: Column | str) -> Column:
    """``left ++ right``: keys of ``right`` override, order of ``left`` kept."""
    return F.map_concat(_col(left), _col(right))


def histogram_tags(field: str, value: Column | str, support: Column | str) -> Column:
    """The three keys the histogram analyzer appends, all as text."""
    return F.create_map(
        F.lit(HISTO_FIELD), F.lit(field),
        F.lit(HISTO_VALU), _col(value).cast("string"),
        F.lit(HISTO_SUPP), _col(support).cast("string"),
    )


def doc_to_json(doc: Column | str) -> Column:
    """Serialise a document map as a JSON object (key order preserved)."""
    return F.to_json(_col(doc))


def doc_size(doc: Column | str) -> Column:
    return F.size(_col(doc))
