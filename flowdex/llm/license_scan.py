"""Licence scans: TF-IDF cosine of statements and licence files to templates, then inheritance down directories.

DataFrame functions only.

1. One scan counts in how many texts each template word occurs (combined on the map side); a second one, once the units
   of 2. are known, does so for every other word that a unit holds: the corpus IDF.
2. A line can only reach the cosine ``LEAST`` to a template if it holds one of the template's heaviest words; lines with
   none of these *cue* words are left where they lie, which loses nothing.  Of files named like a licence, the whole text
   is one unit more.  Each unit is a sparse vector (one row per word) that is joined with the template vectors.
3. A file without a licence of its own takes that of the nearest directory above it that has a licence file: distinct
   directories are joined with the licence files' directories, ancestor by ancestor, and files with their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, small, table, text_or_empty

LEAST = 0.6          # cosine from which a unit names a licence
FILE_SHARE = 0.5     # a file is a licence file if its licence lines hold this share of its words
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"
TOKEN = "[a-z0-9]+"

# How licences are usually stated (public notices and SPDX names).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Licensed under the ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "Released under CC0 1.0 Universal Public Domain Dedication"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("Proprietary", "All rights reserved"),
    ("Proprietary", "Copyright all rights reserved proprietary and confidential"),
)


def _terms(templates) -> list[Counter]:
    return [Counter(re.findall(TOKEN, text.lower())) for _, text in templates]


def _tokens(col: Column) -> Column:
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))


def inverse_frequencies(docs: DataFrame, templates, text_col: str = "text") -> tuple[dict[str, float], int]:
    """(IDF of each template word, number of rows n): ``ln((n + 1) / (df + 1))`` over all rows."""
    words = sorted({w for t in _terms(templates) for w in t})
    seen = docs.select(F.array_intersect(_tokens(text_or_empty(F.col(text_col))), F.array(*map(F.lit, words))).alias("w"))
    # At most one row per template word, and the number of texts, come to the driver.
    counts = {r["w"]: r["n"] for r in seen.select(F.explode("w").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
              .collect()}
    n = docs.count()
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) for w in words}, n


def unit_frequencies(docs: DataFrame, words: DataFrame, n: int, text_col: str = "text") -> DataFrame:
    """``(word, idf)`` of each distinct ``word`` of ``words``, over all ``n`` rows; nothing comes to the driver."""
    wanted = saved(words.select("word").distinct(), "unit_vocabulary")
    texts = docs.select(F.explode(F.array_distinct(_tokens(text_or_empty(F.col(text_col))))).alias("word"))
    # Counted before they are joined, combined on the map side: a common word is then one row of the join.
    seen = texts.groupBy("word").agg(F.count("*").alias("df")).join(small(wanted), "word")
    return saved(seen.select("word", F.log(F.lit(float(n + 1)) / (F.col("df") + 1)).alias("idf")), "unit_idf")


def template_vectors(idf: dict[str, float], templates) -> list[tuple[int, str, str, float]]:
    """(template, licence, word, weight) of unit length; a template whose words are in every text has no vector."""
    out = []
    for i, ((licence, _), terms) in enumerate(zip(templates, _terms(templates))):
        weights = {w: n * idf[w] for w, n in terms.items() if idf[w] > 0}
        length = math.sqrt(sum(v * v for v in weights.values()))
        out += [(i, licence, w, v / length) for w, v in sorted(weights.items())]
    return out


def cue_words(vectors, least: float = LEAST) -> list[str]:
    """Words of which a unit must hold one to reach the cosine ``least`` to any template.

    Without a template's heaviest words, the rest of its unit vector is shorter than ``least``, and so is the cosine.
    """
    cues = set()
    for i in {v[0] for v in vectors}:
        rest = 1.0
        for _, _, w, v in sorted((v for v in vectors if v[0] == i), key=lambda v: (-v[3], v[2])):
            if rest < least * least - 1e-9:
                break
            cues.add(w)
            rest -= v * v
    return sorted(cues)


def _path_parts(path: Column) -> tuple[Column, Column]:
    path = F.regexp_replace(F.coalesce(path.cast("string"), F.lit("")), "^/+", "")
    return path, F.regexp_replace(path, "/?[^/]*$", "")


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, ``license``, ``origin`` (own, inherited, none), ``score``, ``n_statements``.

    The licence of a file is the one of its best unit (then: its first one, then by name); ``score`` is that cosine, for
    inherited ones that of the licence file; several licence files of a directory count by score, then by path.  Null and
    empty texts have no statement, null paths lie in the root.  Rows that repeat an id share its statements; null ids have
    none of their own.  No rows give no rows.
    """
    spark = docs.sparkSession
    idf, n = inverse_frequencies(docs, templates, text_col)
    vectors = template_vectors(idf, templates)
    if not vectors:
        vectors = [(-1, "", "", 0.0)]
    clean, directory = _path_parts(path)
    cue = "(?i)(?<![a-z0-9])(?:" + "|".join(cue_words(vectors, least)) + ")(?![a-z0-9])"
    rows = docs.select(F.col(id_col).alias("id"), clean.alias("path"), directory.alias("dir"),
                       text_or_empty(F.col(text_col)).alias("text"))
    named = F.col("path").rlike(FILE_NAME)
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("unit")))
    lines = F.filter(lines, lambda x: x["unit"].rlike(cue))
    whole = F.when(named, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))).otherwise(
        F.array().cast("array<struct<line:int,unit:string>>"))
    units = (rows.filter(F.col("id").isNotNull() & (F.col("text").rlike(cue) | named))
             .select("id", "path", "dir", named.alias("named"),
                     F.size(_tokens(F.col("text"))).alias("words"), F.explode(F.concat(lines, whole)).alias("u"))
             .select("id", "path", "dir", "named", "words", "u.line", _tokens(F.col("u.unit")).alias("tokens"))
             .withColumn("size", F.size("tokens")).withColumn("unit", F.xxhash64("tokens")))
    key = ["id", "path", "line", "unit"]  # an id may repeat, with the same line or another
    units = saved(units.dropDuplicates(key), "units")
    words = saved(units.select(*key, F.explode("tokens").alias("word")).groupBy(*key, "word")
                  .agg(F.count("*").alias("tf")), "unit_counts")
    words = words.join(small(unit_frequencies(docs, words, n, text_col)), "word").withColumn("w", F.col("tf") * F.col("idf"))
    words = saved(words.select(*key, "word", "w"), "unit_words")
    length = words.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    template = F.broadcast(spark.createDataFrame(vectors, "template int, license string, word string, weight double"))
    cosines = (words.join(template, "word").groupBy(*key, "template", "license")
               .agg(F.sum(F.col("w") * F.col("weight")).alias("dot")).join(length, key)
               .withColumn("score", F.round(F.col("dot") / F.col("len"), 6)).filter(F.col("score") >= least))
    best = cosines.groupBy(*key).agg(F.max(F.struct("score", F.expr("-template").alias("t"), "license")).alias("b"))
    hits = units.join(best, key).select(*key, "dir", "named", "words", "size", "b.score", "b.license", "b.t")
    per_file = saved(hits.groupBy("id", "path", "dir").agg(
        F.max(F.struct("score", F.expr("-line").alias("l"), "t", "license")).alias("b"),
        F.count(F.when(F.col("line") >= 0, 1)).alias("n_statements"),
        F.max("named").alias("named"), F.max("words").alias("words"),
        F.sum(F.when(F.col("line") >= 0, F.col("size")).otherwise(0)).alias("said"))
        .select("id", "path", "dir", "named", "words", "said", "n_statements", "b.score", "b.license"), "licensed")
    own = per_file.groupBy(F.col("id").alias("own_id")).agg(
        F.max(F.struct("score", "n_statements", "license")).alias("own"))
    files = (per_file.filter(F.col("named") | (F.col("said") >= FILE_SHARE * F.col("words")))
             .groupBy(F.col("dir").alias("above"))
             .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("f")))
    parts = F.split("dir", "/")
    chain = F.transform(F.sequence(F.lit(0), F.size(parts)),
                        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    nearest = (rows.select("dir").distinct().select("dir", F.explode(chain).alias("a")).select("dir", "a.depth", "a.above")
               .join(files, "above").groupBy("dir")
               .agg(F.max(F.struct("depth", "f")).alias("near")).select(F.col("dir").alias("near_dir"), "near.f"))
    nearest, own = saved(nearest, "nearest"), saved(own, "own")
    found = (rows.select("id", "dir").join(small(own), F.col("id") == F.col("own_id"), "left")
             .join(small(nearest), F.col("dir") == F.col("near_dir"), "left"))
    license_col = F.coalesce("own.license", "f.license")
    return found.select(
        F.col("id").alias(id_col), license_col.alias("license"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("f").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.coalesce("own.score", -F.col("f.s")).alias("score"),
        F.coalesce("own.n_statements", F.lit(0).cast("long")).alias("n_statements"))


def query(spark, sf_dir: str) -> DataFrame:
    """Each document is a file of its source and language: ``source/lang/doc_id.txt``."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))


def oracle(templates=TEMPLATES, least: float = LEAST) -> str:
    """The same in DuckDB SQL over ``documents``, without the cue words: every line of every text is a vector."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(licence)}, {quote(w)}, {n})" for i, ((licence, _), terms) in
                       enumerate(zip(templates, _terms(templates))) for w, n in sorted(terms.items()))
    return f"""
with tpl(template, license, word, tf) as (values {values}),
d as (select doc_id, coalesce(text, '') t, concat(source, '/', lang, '/', doc_id, '.txt') path,
             concat(source, '/', lang) dir, source from documents),
n as (select count(*) n from d),
df as (select word, count(*) c from (
         select unnest(list_distinct(regexp_extract_all(lower(t), '{TOKEN}'))) word from d) group by word),
idf as (select w.word, ln((n.n + 1) / (coalesce(df.c, 0) + 1)) idf
        from (select word from df union select word from tpl) w cross join n left join df using (word)),
tw as (select template, license, word, tf * idf w from tpl join idf using (word) where idf > 0),
tv as (select template, license, word, w / sqrt(sum(w * w) over (partition by template)) w from tw),
ls as (select doc_id, path, dir, string_split(t, chr(10)) ls from d),
us as (select doc_id, path, dir, unnest(range(len(ls))) line, unnest(ls) u from ls),
uw as (select doc_id, line, word, count(*) tf from (
         select doc_id, line, unnest(regexp_extract_all(lower(u), '{TOKEN}')) word from us) group by all),
ww as (select doc_id, line, word, tf * idf.idf w, tf from uw join idf using (word)),
len as (select doc_id, line, sqrt(sum(w * w)) len, sum(tf) size from ww group by all),
cos as (select doc_id, line, template, license, round(sum(ww.w * tv.w) / any_value(len.len), 6) score, any_value(size) size
        from ww join tv using (word) join len using (doc_id, line) group by all),
hit as (select * from cos where score >= {least}
        qualify row_number() over (partition by doc_id, line order by score desc, template) = 1),
total as (select doc_id, sum(size) words from len group by all),
doc as (select doc_id, count(*) n_statements, sum(size) said,
               first(license order by score desc, line) license, max(score) score from hit group by all),
file as (select dir, first(license order by score desc, path) license, max(score) score
         from doc join total using (doc_id) join d using (doc_id) where said >= {FILE_SHARE} * words group by all),
near as (select dir, license, score from (
           select x.dir, f.license, f.score, length(f.dir) depth from (select distinct dir, source from d) x
           join file f on f.dir = x.dir or f.dir = x.source)
         qualify row_number() over (partition by dir order by depth desc) = 1)
select d.doc_id, coalesce(doc.license, near.license) license,
       case when doc.license is not null then 'own' when near.license is not null then 'inherited' else 'none' end origin,
       coalesce(doc.score, near.score) score, coalesce(n_statements, 0) n_statements
from d left join doc using (doc_id) left join near using (dir)
"""


ORACLE = oracle()
