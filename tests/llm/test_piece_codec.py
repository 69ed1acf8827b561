import hashlib
import random

import numpy as np
import pytest
import sentencepiece as spm

from flowdex.llm import piece_codec as pc
from flowdex.llm.piece_model import PieceModel

SCHEMA = "doc_id long, text string, ids string, n_tokens int"
ODD = [None, "", " ", "   ", "\n", " a", "a ", "▁x", "ﬁ Ａ ½ x́", "<s> hi </s>", "日本𝄞", "a\u0000b", "x" * 5000, "ab" * 3000, " " * 700,
       "tab\there", "naïve café\r\nÀ", "12.5%!!"]


def random_texts(n=600):
    rng = random.Random(3)
    alphabet = "ab  \n\t▁é日𝄞ﬁＡ½<s>0x́.,'e"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=pc.public_model())


def test_digests_match_the_library(spark, library):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in table] + list(enumerate(ODD + random_texts(), 10_000)) + [(1, "twice"), (1, "twice")]
    docs = spark.createDataFrame([(a, b, "clash", 0) for a, b in rows], SCHEMA)
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = pc.digests(docs).drop("spans_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_spans_cover_the_source(spark):
    texts = [t for t in ODD if t is not None] + random_texts(200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    codec = pc.load(pc.public_model())
    for r in pc.encode(docs).collect():
        data = texts[r.doc_id].encode()
        assert r.starts[0] == r.ends[0] == 0 and r.starts[-1] == r.ends[-1] == len(data)
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends)) == data
        for i, a, b in zip(r.ids[1:-1], r.starts[1:-1], r.ends[1:-1]):
            piece = codec.byte_of.get(i) or codec.pieces[i].replace("▁", " ").encode()
            assert data[a:b].replace("▁".encode(), b" ") in (piece, piece[1:])


def test_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(random_texts(100))), "doc_id long, text string")
    back = {r.doc_id: r.text for r in pc.decode(pc.encode(docs)).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in enumerate(random_texts(100))}


def with_normaliser(rule):
    """The public model with another normaliser's compiled character map (field 3 of the file is exchanged)."""
    from flowdex.llm.piece_model import _fields

    other = spm.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def wrapped(field, value):
        return varint(field << 3 | 2) + varint(len(value)) + value

    own = open(pc.public_model(), "rb").read()
    out = b"".join(wrapped(f, v) for f, v in _fields(own) if f != 3)
    return out + b"".join(wrapped(3, v) for f, v in _fields(other) if f == 3)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_longest_prefix_normalisation(rule):
    data = with_normaliser(rule)
    library, own = spm.SentencePieceProcessor(model_proto=data), PieceModel(data)
    assert own.map.units
    for text in [t for t in ODD if t is not None and len(t) < 100] + random_texts():
        ids, places = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        for k, (i, span) in enumerate(zip(ids.tolist(), spans)):
            if i not in own.byte_of:
                assert (places[k], places[k + 1]) == span, (text, k)


def test_empty_table(spark):
    assert pc.digests(spark.createDataFrame([], SCHEMA)).collect() == []
    assert pc.encode(spark.createDataFrame([], SCHEMA)).collect() == []
