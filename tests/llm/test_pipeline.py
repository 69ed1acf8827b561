import collections
import re

import corpus_pipeline as cp
from flowdex.llm import best_fit_packing, language_crf, secret_forest
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_minhash_join import brute as near_brute

DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    found = {r.doc_id: r for r in language_crf.predict(docs, language_crf.learn(docs)).collect()}

    df = cp.language(spark, docs, DIR)
    kept = {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    assert kept == {i for i, r in found.items() if r.lang_pred != "und"}
    assert df.columns == columns and {r.doc_id for r in df.collect()} == kept

    df = cp.exact(spark, docs, DIR)
    want = {b[0] for b in exact_brute([(i, r.text) for i, r in rows.items()]) if b[3]}
    assert df.columns == columns and {r.doc_id for r in df.collect()} == want and len(want) < len(rows)

    df = cp.near(spark, docs, DIR)
    want = {b[0] for b in near_brute([(i, r.text) for i, r in rows.items()]) if b[0] == b[1]}
    assert df.columns == columns and {r.doc_id for r in df.collect()} == want

    df = cp.secrets(spark, docs, DIR)
    got = {r.doc_id: r for r in df.collect()}
    assert df.columns == columns and set(got) == set(rows)
    for i, r in rows.items():
        clean = re.sub(r'(?i)(token = ")[0-9a-f]{40}', lambda m: m[1] + secret_forest.MASK, r.text)
        assert got[i].text == clean and got[i].n_chars == (r.n_chars if clean == r.text else len(clean))


def test_run_is_the_chain(spark):
    out = cp.run(spark, DIR).collect()
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
    last = {r.doc_id: r for r in docs.collect()}
    total = collections.Counter()
    used = collections.defaultdict(list)
    for r in out:
        total[r.doc_id] += r.length
        used[r.bin_id].append(r)
    assert dict(total) == {i: len(r.text.split()) for i, r in last.items()}
    for parts in used.values():
        assert sum(r.length for r in parts) <= best_fit_packing.CAPACITY
        assert len({last[r.doc_id].source for r in parts}) == len(parts)


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, drop_id long, secrets string, shared int"


def test_stages_on_odd_rows(spark):
    prose = "the king and the queen of the house were in the garden with the old dog "
    texts = [(1, None), (2, ""), (3, "12 !"), (4, prose * 3), (4, prose * 3), (5, prose * 3), (6, "w" * 200_000),
             (7, prose * 8000), (8, prose + 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + prose), (None, prose * 2),
             (9, prose.replace("dog", "cat"))]
    rows = [(i, t, "en" if k % 2 else None, "src0" if k % 3 else None, None if t is None else len(t), "r", 4, "s", k)
            for k, (i, t) in enumerate(texts)]
    start = spark.createDataFrame(rows, ODD)
    ids = lambda df: sorted(r.doc_id for r in df.collect() if r.doc_id is not None)
    docs = cp.saved(cp.language(spark, start, DIR), "t")
    assert docs.columns == start.columns and ids(docs) == [4, 4, 5, 6, 7, 8, 9]
    docs = cp.saved(cp.exact(spark, docs, DIR), "t")
    assert docs.columns == start.columns and ids(docs) == [4, 6, 7, 8, 9]
    docs = cp.saved(cp.near(spark, docs, DIR), "t")
    # Repetitions of a sentence have the same shingles, so 7 goes with 4, as does the row without an id.
    assert docs.columns == start.columns and ids(docs) == [4, 6, 8, 9]
    docs = cp.saved(cp.secrets(spark, docs, DIR), "t")
    assert docs.columns == start.columns and ids(docs) == [4, 6, 8, 9]
    assert "24be" not in "".join(r.text for r in docs.collect())
    packed = cp.packing(spark, docs, DIR)
    assert sorted({r.doc_id for r in packed.collect() if r.doc_id is not None}) == [4, 6, 8, 9]
    for _, stage in cp.STAGES:
        assert stage(spark, start.limit(0), DIR).collect() == []
