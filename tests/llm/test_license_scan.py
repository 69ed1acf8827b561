import math
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from flowdex.llm import license_scan as ls

MIT = "Released under the MIT License."


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "doc_id long, path string, text string, license string, words int")


def brute(rows):
    """Every line of every file, dense dictionaries, no cue words."""
    token = lambda t: re.findall(ls.TOKEN, (t or "").lower())
    df = Counter(w for *_, t in rows for w in set(token(t)))
    n = len(rows)
    idf = lambda w: math.log((n + 1) / (df[w] + 1))

    def vector(words):
        v = {w: c * idf(w) for w, c in Counter(words).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()} if size else {}

    templates = [(lic, vector(token(t))) for lic, t in ls.TEMPLATES]
    own, files = {}, {}
    for i, path, text in rows:
        path = (path or "").lstrip("/")
        named = bool(re.search(ls.FILE_NAME, path))
        units = list(enumerate((text or "").split("\n"))) + ([(-1, text or "")] if named else [])
        hits, said = [], 0
        for line, u in units:
            v = vector(token(u))
            score, k = max((round(sum(x * t.get(w, 0) for w, x in v.items()), 6), -k) for k, (_, t) in enumerate(templates))
            if score >= ls.LEAST:
                hits.append((score, -line, k, templates[-k][0]))
                said += len(token(u)) * (line >= 0)
        if hits:
            own[i] = (max(hits)[3], max(hits)[0], sum(h[1] <= 0 for h in hits))
            if named or said >= ls.FILE_SHARE * len(token(text)):
                folder = path.rpartition("/")[0]
                files.setdefault(folder, []).append((-max(hits)[0], path, max(hits)[3]))
    out = []
    for i, path, _ in rows:
        folder = (path or "").lstrip("/").rpartition("/")[0]
        parts = folder.split("/") if folder else []
        above = ["/".join(parts[:k]) for k in range(len(parts), -1, -1)]
        near = next((min(files[a]) for a in above if a in files), None)
        if i in own:
            out.append((i, own[i][0], "own", own[i][1], own[i][2]))
        elif near:
            out.append((i, near[2], "inherited", -near[0], 0))
        else:
            out.append((i, None, "none", None, 0))
    return out


def test_inheritance_and_edges(spark):
    prose = "some words about the version of a thing and its license\n" * 3
    rows = [(1, "a/LICENSE", "The MIT License\n\n" + MIT), (2, "a/x.py", prose), (3, "a/b/y.py", prose),
            (4, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
            (5, "a/b/c/z.py", prose + "# SPDX-License-Identifier: Apache-2.0\n"), (6, "q/r.py", None), (7, None, ""),
            (8, "/a/b/c/d.txt", "w " * 60_000), (9, "q/s.py", prose + MIT), (10, "ab/x.py", prose),
            (11, "a/LICENSE.old", "ALL RIGHTS RESERVED"), (12, "t/u.txt", MIT), (13, "t/v/w.txt", prose)]
    rows += [(100 + i, f"n/{i}.txt", prose) for i in range(20)]
    docs = frame(spark, rows)
    got = sorted(ls.scan(docs, F.col("path")).collect())
    want = brute(rows)
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert all((g.score is None) == (w[3] is None) and (w[3] is None or abs(g.score - w[3]) < 2e-6)
               for g, w in zip(got, want))
    by = {r.doc_id: (r.license, r.origin) for r in got}
    assert by[2] == ("MIT", "inherited") and by[3] == by[8] == ("GPL-3.0", "inherited") and by[10][1] == "none"
    assert by[5] == ("Apache-2.0", "own") and by[13] == ("MIT", "inherited")


def test_repeated_rows_and_empty_table(spark):
    docs = frame(spark, [(1, "a/x", MIT), (1, "a/x", MIT), (2, "a/y", "other words"), (None, "a/z", MIT)])
    got = ls.scan(docs, F.col("path")).collect()
    assert len(got) == 4 and [r.origin for r in got if r.doc_id == 1] == ["own", "own"]
    assert ls.scan(docs.limit(0), F.col("path")).collect() == []


def test_ordinary_words_weigh_little(spark):
    said = ["Licensed under the MIT License that was", "it was licensed under the ISC License and that is it"]
    rows = [(i, f"p{i}/x", said[i] if i < 2 else f"it was said that this and the other is word{i}") for i in range(400)]
    token = lambda t: re.findall(ls.TOKEN, t.lower())
    df = Counter(w for *_, t in rows for w in set(token(t)))

    def vector(text):
        v = {w: c * math.log(401 / (df[w] + 1)) for w, c in Counter(token(text)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    got = {r.doc_id: r for r in ls.scan(frame(spark, rows), F.col("path")).collect()}
    for i, template in ((0, "Licensed under the MIT License"), (1, "Licensed under the ISC License")):
        a, b = vector(said[i]), vector(template)
        assert got[i].license == template.split()[3] and got[i].origin == "own"
        assert abs(got[i].score - sum(x * b.get(w, 0) for w, x in a.items())) < 2e-6 and got[i].score > 0.9
    assert all(got[i].origin == "none" for i in range(2, 400))
    want = brute([(i, p, t) for i, p, t in rows])
    assert [(r[0], r[1], r[2], r[4]) for r in sorted(got.values())] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert all(w[3] is None or abs(got[w[0]].score - w[3]) < 2e-6 for w in want)


def test_oracle_follows_the_corpus(spark):
    """A table on which the words of a statement are common: the SQL and the operator agree."""
    said = ["Licensed under the MIT License that was", "it was licensed under the ISC License and that is it"]
    rows = [(i, said[i] if i < 2 else f"it was said that this and the other is word{i}", "en", f"s{i % 7}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = ls.scan(docs, F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))).collect()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(ls.ORACLE).fetchall()
    key = lambda r: (r[0], r[1], r[2], None if r[3] is None else round(r[3], 5), r[4])
    assert sorted(map(key, map(tuple, got)), key=str) == sorted(map(key, want), key=str)
    assert sum(r.origin == "own" for r in got) == 2
