"""Search-index sink.

Documents are ``map<string,string>`` rows.  With the index connector on the
classpath they go to the cluster (``format="org.elasticsearch.spark.sql"``);
otherwise to an index *directory* ``<root>/<index>/<mapping>`` with a commit log
(:mod:`flowdex.sinks.commit_log`): a replayed micro-batch replaces its own documents
in one step, so it duplicates nothing and readers (:func:`read_index`) see the old
batch or the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.operators.documents import prepare_documents
from flowdex.sinks.commit_log import read_committed, write_committed

CONNECTOR_FORMAT = "org.elasticsearch.spark.sql"


FIELD_LIMIT = 1000  # the index's own default limit of fields


def index_options(nodes: str, port: int | str, index: str, mapping: str,
                  id_col: str | None = None) -> dict[str, str]:
    """Connector settings: nodes, port, the ``index/mapping`` resource; ``id_col`` names the document id field."""
    opts = {"es.nodes": nodes, "es.port": str(port), "es.resource": f"{index}/{mapping}"}
    if id_col:
        opts["es.mapping.id"] = id_col
    return opts


def index_path(root: str, index: str, mapping: str) -> str:
    return f"{root.rstrip('/')}/{index}/{mapping}"


def with_documents(messages: DataFrame, doc_col: str = "doc", value_col: str = "value") -> DataFrame:
    """``messages`` with their document: what leaves an analyzer as text is prepared here, other columns stay."""
    if doc_col in messages.columns:
        return messages
    keep = [c for c in messages.columns if c != value_col]
    return prepare_documents(messages, value_col, keep).withColumnRenamed("doc", doc_col)


def connector_documents(docs: DataFrame, doc_col: str = "doc", id_col: str | None = None,
                        fields: Sequence[str] | None = None) -> DataFrame:
    """Flat documents as the connector's DataFrame source takes them: one text column per field.

    ``fields`` default to the keys found in the batch (one aggregate; more than ``FIELD_LIMIT`` are refused, as the
    index would).  A field that a document lacks is NULL, which the connector leaves out.
    """
    if fields is None:
        found = docs.select(F.explode(F.map_keys(doc_col)).alias("k")).distinct().orderBy("k").limit(FIELD_LIMIT + 1)
        fields = [r["k"] for r in found.collect()]
    if len(fields) > FIELD_LIMIT:
        raise ValueError(f"documents with more than {FIELD_LIMIT} fields")
    doc = F.col(doc_col)
    cols = [F.try_element_at(doc, F.lit(f)).alias(f) for f in fields if f != id_col]
    return docs.select(*([F.col(id_col).cast("string").alias(id_col)] if id_col else []), *cols)


def write_index(docs: DataFrame, target: str, batch_id: int = 0, doc_col: str = "doc",
                id_col: str | None = None, fmt: str = "parquet",
                options: dict[str, str] | None = None) -> None:
    """Write one batch of documents, or of messages that are made into documents first.

    ``fmt`` = ``parquet``/``json``: ``target`` is the index directory; the
    batch is replaced in one step.  Columns: the id column (when given) and ``doc``.
    ``fmt`` = the connector format: ``target`` is unused, ``options`` (see
    :func:`index_options`) address the cluster.
    """
    docs = with_documents(docs, doc_col)
    if fmt == CONNECTOR_FORMAT:
        (connector_documents(docs, doc_col, id_col).write.format(fmt)
         .options(**(options or {})).mode("append").save())
        return
    cols = ([F.col(id_col)] if id_col else []) + [F.col(doc_col).alias("doc")]
    write_committed(docs.select(*cols), target, batch_id, fmt)


def read_index(spark: SparkSession, target: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """The documents of an index directory with their ``batch_id``: of every batch the attempt that counts now."""
    return read_committed(spark, target, fmt, schema)


def index_sink(target: str, doc_col: str = "doc", id_col: str | None = None, fmt: str = "parquet",
               options: dict[str, str] | None = None):
    """A ``(DataFrame, batch_id) -> None`` sink for :func:`flowdex.streaming.runner.start_indexing`.

    It takes the output of any analyzer: documents in ``doc_col``, or else text messages in ``value``.
    """
    def sink(docs: DataFrame, batch_id: int) -> None:
        write_index(docs, target, batch_id, doc_col, id_col, fmt, options)
    return sink
