"""SQL analyzer: JSON messages -> records -> one SQL statement -> report rows / JSON.

Per micro-batch (or per table), messages are parsed with a declared schema -- or
an inferred one -- exposed as a view, and a SQL statement runs over it.  The
statement, view name and schema are parameters; the default is the reference's
log report.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowdex.operators.topk import top_k_per_group
from flowdex.session import ensure_duplicate_keys

# The reference's view name, the log record it implies, and its
# report statement.  The statement is the reference's, except that ``host`` is
# added as a second sort key so the top 100 is deterministic under ties.
DEFAULT_VIEW = "logstash"
LOG_SCHEMA = "host string, path string, lineno bigint"
REPORT_PATH = "/var/log/system.log"
REPORT_MIN_LINENO = 70
REPORT_LIMIT = 100
DEFAULT_STATEMENT = (
    "SELECT host, COUNT(host) AS host_c, AVG(lineno) AS line_a FROM logstash "
    "WHERE path = '/var/log/system.log' AND lineno > 70 "
    "GROUP BY host ORDER BY host_c DESC, host ASC NULLS LAST LIMIT 100"
)


def parse_records(messages: DataFrame, schema: str | StructType | None = LOG_SCHEMA,
                  value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame | None:
    """JSON text -> typed columns.  ``schema=None`` infers it from the messages.

    Returns None when inference finds no JSON object (e.g. an empty batch).
    """
    if schema is None:
        schema = infer_json_schema(messages, value_col)
        if schema is None:
            return None
    return parse_once(messages, value_col, schema, keep).select(*keep, "__r.*")


def parse_once(messages: DataFrame, value_col: str, schema: str | StructType, keep: Sequence[str] = (),
               alias: str = "__r") -> DataFrame:
    """``from_json`` evaluated exactly once per message, as struct column ``alias``.

    Predicates on parsed fields would otherwise be pushed below the projection
    and re-run the parse once per predicate (and again for the projection).
    Parsing inside a one-element ``explode`` (a ``Generate``, always one output
    row, NULL struct for unparsable text) keeps every filter above the parse.
    """
    parsed = F.explode(F.array(F.from_json(value_col, schema)))
    return messages.select(*keep, parsed.alias(alias))


def infer_json_schema(messages: DataFrame, value_col: str = "value") -> str | None:
    """Schema of the JSON objects in ``value_col``, merged over all rows (one aggregate job).

    Non-objects are ignored; mixed numeric types widen as Spark's variant
    schema merge does.  Of a member that an object repeats the last one counts,
    as in the parse (``spark.sql.variant.allowDuplicateKeys``, set by
    :func:`flowdex.session.configure`).  Returns a DDL string usable by ``from_json``.
    """
    ensure_duplicate_keys(messages.sparkSession)
    v = F.try_parse_json(value_col)
    objects = messages.select(v.alias("__v")).where(
        F.schema_of_variant("__v").startswith("OBJECT<"))
    row = objects.select(F.schema_of_variant_agg("__v").alias("s")).first()
    if row is None or row["s"] is None or not row["s"].startswith("OBJECT<"):
        return None
    return variant_schema_to_ddl(row["s"])


def variant_schema_to_ddl(schema: str) -> str:
    """``OBJECT<a: BIGINT, b: OBJECT<c: STRING>>`` -> a struct DDL string; quoted names stay as they are."""
    return re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", schema)


def sql_analyzer(messages: DataFrame, statement: str = DEFAULT_STATEMENT,
                 view: str = DEFAULT_VIEW, schema: str | StructType | None = LOG_SCHEMA,
                 value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame | None:
    """Run ``statement`` over the parsed messages exposed as ``view``.

    The view is bound as a DataFrame argument (no catalog side effect) whether
    the statement writes ``{view}`` or the plain name; only statements where
    the plain name cannot be rewritten unambiguously fall back to a temp view.
    Returns None for a batch without any JSON object under inference.
    """
    records = parse_records(messages, schema, value_col, keep)
    if records is None:
        return None
    spark = messages.sparkSession
    bound = statement if "{" + view + "}" in statement else bind_view(statement, view)
    if bound is not None:
        return spark.sql(bound, **{view: records})
    records.createOrReplaceTempView(view)
    return spark.sql(statement)


# Words of SQL that may follow a table and aren't its alias.
AFTER_TABLE = ("where group order having limit offset join inner left right full cross natural anti semi on using union "
               "except intersect minus lateral window sort distribute cluster tablesample pivot unpivot").split()


def bind_view(statement: str, view: str) -> str | None:
    """The statement with ``view`` in table position (after FROM or JOIN) turned into ``{view}``.

    Binding the batch as a DataFrame argument leaves the session catalog alone,
    so concurrent analyzers on one session cannot swap each other's view.
    A table without an alias keeps the view's name as one, so qualified columns
    still resolve; columns and aliases of the same name are left untouched.
    None where that isn't certain (braces, double quotes, comments, a table
    after a comma): the caller then uses a temp view.
    """
    if any(c in statement for c in ('{', '}', '"', "--", "/*")):
        return None
    name = rf"`?{re.escape(view)}`?(?![\w`.])"
    pieces = statement.split("'")
    code = " '' ".join(pieces[::2])
    if re.search(rf"\bFROM\b[^()]*,\s*{name}", code, re.IGNORECASE | re.DOTALL):
        return None
    alias = re.compile(rf"\s+(?:AS\s+\w+|(?!(?:{'|'.join(AFTER_TABLE)})\b)[A-Za-z_`]\w*)", re.IGNORECASE)

    def bound(piece: str) -> str:
        def put(m):
            own = "" if alias.match(piece, m.end()) else f" AS {view}"
            return m[1] + "{" + view + "}" + own
        return re.sub(rf"(\b(?:FROM|JOIN)\s+){name}", put, piece, flags=re.IGNORECASE)

    pieces[::2] = [bound(p) for p in pieces[::2]]
    out = "'".join(pieces)
    return out if out != statement else None


def report_filter(records: DataFrame) -> DataFrame:
    return records.where((F.col("path") == REPORT_PATH) & (F.col("lineno") > REPORT_MIN_LINENO))


def report_aggregate(records: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``COUNT(host) host_c, AVG(lineno) line_a`` per host (and extra group columns)."""
    return (report_filter(records)
            .groupBy(*group_cols, "host")
            .agg(F.count("host").alias("host_c"), F.avg("lineno").alias("line_a")))


def report_by_batch(records: DataFrame, batch_col: str = "batch", k: int = REPORT_LIMIT) -> DataFrame:
    """The report per micro-batch on a table with a batch column: top ``k`` hosts per batch."""
    agg = report_aggregate(records, [batch_col])
    order = [F.col("host_c").desc(), F.col("host").asc_nulls_last()]
    return top_k_per_group(agg, [batch_col], order, k, salt_cols=["host"])


def render_report(report: DataFrame, mean_decimals: int | None = None,
                  legacy_keys: bool = False) -> DataFrame:
    """Report rows -> JSON text ``{"host":..,"count":..,"mean":..}`` (escaped; null host omitted).

    ``legacy_keys=True`` names the mean ``sum`` as the reference's text does.
    ``mean_decimals`` renders the mean as a fixed-scale decimal.
    """
    mean: Column = F.col("line_a")
    if mean_decimals is not None:
        mean = mean.cast(f"decimal(18,{int(mean_decimals)})")
    mean_key = "sum" if legacy_keys else "mean"
    return report.select(F.to_json(F.struct(
        F.col("host"), F.col("host_c").alias("count"), mean.alias(mean_key))).alias("value"))


def render_rows(report: DataFrame) -> DataFrame:
    """Rows of any report -> JSON text with the report's own column names (escaped; null members omitted)."""
    return report.select(F.to_json(F.struct("*")).alias("value"))
