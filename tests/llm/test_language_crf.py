import zlib

import numpy as np

from flowdex.llm import language_crf as lc

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = lc.predict(docs, lc.learn(docs)).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert len(lc.identified(docs).collect()) >= 990


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = lc.Model(["a", "b", "c"], {})
    model.transition[:] = rng.normal(size=(3, 3))
    model.start[:] = rng.normal(size=3)
    emit = rng.normal(size=(1, 4, 3)).astype(np.float32)
    want, total = np.zeros((4, 3)), 0.0
    for path in np.ndindex(3, 3, 3, 3):
        s = model.start[path[0]] + sum(emit[0, t, y] for t, y in enumerate(path))
        s = np.exp(s + sum(model.transition[path[t], path[t + 1]] for t in range(3)))
        total += s
        for t, y in enumerate(path):
            want[t, y] += s
    assert np.allclose(lc._marginals(emit, np.array([4]), model)[0], want / total, atol=1e-5)
    prob, moves = lc.forward_backward(np.concatenate([emit, emit], 1)[:, :6], np.array([4]), model)
    assert np.allclose(prob[0, :4], want / total, atol=1e-6) and np.isclose(moves.sum(), 3)


def test_mixed_text_is_labelled_word_by_word(spark):
    rows = [(i, ("the house of the king and the queen " if i % 2 else "le roi et la reine dans une maison ") * 5,
             "en" if i % 2 else "fr") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lc.learn(docs)
    mixed = spark.createDataFrame([(1, "the king and the queen le roi et la reine"), (2, None), (3, "12 !")],
                                  "doc_id long, text string")
    out = {r.doc_id: r.words for r in lc.label_words(mixed, model).collect()}
    assert [w.lang for w in out[1]] == ["en"] * 5 + ["fr"] * 5 and out[2] == out[3] == []


def test_texts_in_several_languages_stay(spark):
    texts = {"en": "the house of the king and the queen ", "fr": "le roi et la reine dans une maison ",
             "de": "der hund und die katze sind nicht im haus "}
    langs = sorted(texts)
    train = [(i, texts[langs[i % 3]] * 5, langs[i % 3]) for i in range(90)]
    mixed = [(1000, texts["en"] * 8 + texts["fr"] * 8), (1001, texts["fr"] * 8 + texts["de"] * 8),
             (1002, "".join(texts[x] * 8 for x in langs)), (1003, "".join(texts[x] for x in langs) * 20)]
    rows = train + [(i, t, None) for i, t in mixed] + [(1004, None, None), (1005, "12 !", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in lc.predict(docs, lc.learn(docs)).collect()}
    assert min(scores[1002], scores[1003]) < 0.5
    kept = {r.doc_id for r in lc.identified(docs).collect()}
    assert kept == set(range(90)) | {i for i, _ in mixed}


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ...", None), (4, "the cat " * 40_000, None), (5, "the cat", "en"),
            (5, "the cat", "en"), (None, "the", "en"), (6, "le chat", "fr"), (7, "le chat noir", "fr"), (8, "the dog", "en")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in lc.predict(docs, lc.learn(docs)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3)) and got[4].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = lc.identified(docs)
    assert kept.columns == docs.columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}
    empty = docs.limit(0)
    assert lc.predict(empty, lc.learn(empty)).collect() == []
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang").select(docs.columns)
    assert sorted(str(r.doc_id) for r in lc.identified(unlabelled).collect()) == sorted("4 5 5 None 6 7 8".split())
    assert {r.lang_pred for r in lc.predict(docs, lc.learn(empty)).collect()} == {"und"}


EN, FR = "the house of the king and the queen is not far from here ", "le roi et la reine sont dans une maison pas loin "


def test_languages_of_long_texts_alone(spark):
    rows = [(i, (EN if i % 2 else FR) * 480, "en" if i % 2 else "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(rows[0][1]) > 20_000
    model = lc.learn(docs)
    assert model.langs == ["en", "fr"] and len(lc.identified(docs).collect()) == 40
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "fr") for r in lc.predict(docs, model).collect())
    short = [(100 + i, EN, "en") for i in range(40)]
    mixed = spark.createDataFrame(short + [r for r in rows if r[2] == "fr"], "doc_id long, text string, lang string")
    assert lc.learn(mixed).langs == ["en", "fr"]


def test_every_label_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = np.random.default_rng(5)
    rows = []
    for k in range(70):
        words = ["".join(rng.choice(list(letters), 6)) for _ in range(12)]
        rows += [(k * 10 + i, " ".join(rng.choice(words, 40)), f"l{k:02d}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lc.learn(docs)
    assert len(model.langs) == 70
    got = lc.predict(docs, model).collect()
    truth = {r[0]: r[2] for r in rows}
    assert {r.lang_pred for r in got} == set(model.langs)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.9


def test_letters_and_long_words():
    assert lc.words_of("\u00b2 \u00bd \u2460 \u2167 12 _ !") == [] and lc.words_of("x\u00b2y Stra\u00dfe \u4e00") == ["x", "y", "stra\u00dfe", "\u4e00"]
    run = "\u0e01\u0e02\u0e04" * 30
    assert "".join(lc.words_of(run)) == run and max(map(len, lc.words_of(run))) <= lc.LONGEST
    assert lc.words_of(None) == lc.words_of("") == []


def test_what_the_model_says_counts(spark):
    rows = [(i, (EN if i % 2 else FR) * 3, "en" if i % 2 else "fr") for i in range(40)]
    rows += [(100, EN, None), (101, FR, None), (102, EN + FR, None), (103, FR, "en"), (104, "12", None)]
    rows += [(105, "\u0436\u0449\u0444 \u044d\u044e\u0439 \u0446\u0447\u0431", None)]  # letters of neither language
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in lc.identified(docs).collect()}
    assert set(got) == set(range(40)) | {100, 101, 102, 103}
    assert got[100] == "en" and got[101] == "fr" and got[102] in ("en", "fr") and got[103] == "en"
    assert 105 in {r.doc_id for r in lc.identified(docs, least=0.0).collect()}
