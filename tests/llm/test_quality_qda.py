import zlib

import numpy as np

from flowdex.llm import quality_qda as qq

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = qq.score(docs, labels).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_scores_do_not_read_labels_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    other = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) "
                              "as quality")
    key = lambda df: sorted((r.doc_id, round(r.score, 9)) for r in df.collect())
    assert key(qq.score(docs, labels)) == key(qq.score(docs, other))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 60_000), (4, "a!"), (4, "a!"), (None, "x"), (5, "\n \t")]
    docs = spark.createDataFrame([(a, b, "clash", 0.5) for a, b in rows], "doc_id long, text string, x string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1), (3, None), (None, 0)], "doc_id long, quality int")
    assert {r.score for r in qq.score(docs, none).collect()} == {0.5}
    assert {(r.score, r.predicted) for r in qq.score(docs, one).collect()} == {(1.0, 1)}
    both = spark.createDataFrame([(3, 1), (2, 0), (4, 0), (5, 1), (5, 0)], "doc_id long, quality int")
    got = qq.score(docs, both)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = {r.doc_id: (r.score, r.predicted) for r in got.collect()}
    assert out[1] == out[2] == out[5] and len(out) == 6 and all(0 <= s <= 1 for s, _ in out.values())
    assert qq.score(docs.limit(0), both).collect() == []


def test_runs_of_marks_count_in_every_text():
    at = qq.FEATURES.index("mark_runs")
    for run in ("...", "???", ".,", "\u2026\u2026", "\u3002\u201d", "--", "!!"):
        text = f"one two{run} three four{run}"
        assert np.isclose(qq.features(text)[at], np.sqrt(2 / 4)) and qq.features(text + " a-b")[at] == np.sqrt(2 / 5)
    assert qq.features("one, two. three? four")[at] == 0


def test_cholesky_form_equals_the_density():
    rng = np.random.default_rng(0)
    d = 3
    x = [rng.normal(size=(50, d)), rng.normal(size=(80, d)) * 2 + 1]
    model = qq.Discriminant(np.array([50.0, 80.0]), np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]))
    pooled = sum((len(a) - 1) * np.cov(a.T) for a in x) / 128 + qq.FLOOR ** 2 * np.eye(d)
    logs = []
    for a in x:
        s = ((1 - qq.SHRINK - qq.DIAGONAL) * np.cov(a.T) + qq.SHRINK * pooled + qq.DIAGONAL * np.diag(np.diag(pooled)))
        z = x[1] - a.mean(0)
        logs.append(np.log(len(a) / 130) - 0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z)))
    assert np.allclose(model.scores(x[1]), 1 / (1 + np.exp(logs[0] - logs[1])))
