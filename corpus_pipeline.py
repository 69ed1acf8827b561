"""Corpus pipeline: documents -> packed training bins, in five stages written and reread as Parquet.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowdex.llm import best_fit_packing, exact_dedup, language_crf, minhash_join, secret_forest
from flowdex.llm.common import saved, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go, those without a label get one; the model is learned from the labelled
    documents of this input."""
    return language_crf.identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word Jaccard similarity of 0.8 or more the one with the smallest id stays."""
    return minhash_join.one_per_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mask, and ``n_chars`` follows."""
    return secret_forest.redacted(docs, path=F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, bin_id, offset, length``: every word of every document has its place in a bin."""
    return best_fit_packing.pack_documents(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("secrets", secrets), ("packing", packing)]

# Learned models and graph components are beyond SQL: tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
