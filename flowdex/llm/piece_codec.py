"""Offset-preserving sentencepiece encoding and decoding of a table of texts.

Each text is normalised by longest prefixes of the model's compiled character map while the source place of every
normalised byte is recorded; BPE merges make the pieces, and each piece is projected to the bytes of the source text it
stands for.  Work is per text and per Arrow batch, in the tasks that read the table; nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import table, text_batches, values
from flowdex.llm.piece_model import PieceModel

MODEL = "piece_bpe_32k.model"

_MODELS: dict[str, PieceModel] = {}


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def load(path: str) -> PieceModel:
    """The model of a file, read once in each process."""
    if path not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path] = PieceModel(f.read())
    return _MODELS[path]


def _model(path: str | None) -> PieceModel:
    return load(path or public_model())


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``ids`` (with begin and end), ``starts`` and ``ends``.

    ``starts[i]:ends[i]`` are the bytes of the UTF-8 text that ``ids[i]`` stands for; begin and end have empty spans at
    the text's ends, and a piece that the normaliser adds (the dummy prefix) covers no byte.  A null text is empty: its
    ids are begin and end alone.  Rows stay in place, repeated ones too; other columns are not read.
    """

    def run(batches):
        codec = _model(model)
        for batch in batches:
            ids, starts, ends, offsets = [], [], [], [0]
            for text in values(batch.column(1)):
                got, places = codec.encode(text or "")
                last = len((text or "").encode())
                ids.append(np.concatenate([[codec.begin], got, [codec.end]]))
                starts.append(np.concatenate([[0], places[:-1], [last]]))
                ends.append(np.concatenate([[0], places[1:], [last]]))
                offsets.append(offsets[-1] + len(got) + 2)
            offsets = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else [], t))
                     for x, t in ((ids, pa.int32()), (starts, pa.int32()), (ends, pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["id", "ids", "starts", "ends"])

    src = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, id_col: str = "doc_id", model: str | None = None) -> DataFrame:
    """``(id, text)`` of ``(id, ids)``; null ids give null."""

    def run(batches):
        codec = _model(model)
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    src = encoded.select(F.col(id_col).alias("id"), "ids")
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``spans_sha256`` (starts, then ends, as 32-bit numbers).

    The same encoding and decoding as ``encode`` and ``decode``, hashed where they are made instead of returned.
    """

    def run(batches):
        codec = _model(model)
        for batch in batches:
            rows = []
            for text in values(batch.column(1)):
                got, places = codec.encode(text or "")
                ids = np.concatenate([[codec.begin], got, [codec.end]])
                back = codec.decode(ids.tolist())
                rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                             hashlib.sha256(back.encode()).hexdigest(),
                             hashlib.sha256(places.astype("<u4").tobytes()).hexdigest()))
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    src = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                                "spans_sha256 string").withColumnRenamed("id", id_col))


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
