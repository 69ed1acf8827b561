import hashlib
import re

from flowdex.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, keep_id string, `full` string"
LONG = "y" * 300_000
ROWS = [(9, "a  b"), (3, "a\tb"), (4, "a b "), (5, None), (6, ""), (7, " "), (8, LONG), (2, LONG), (1, LONG[:-1] + "z"),
        (11, "same"), (11, "same"), (12, "a b"), (13, "p" * 256 + "1"), (14, "p" * 256 + "2")]


def brute(rows):
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    out, done = [], set()
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        out.append((i, min(same), len(same), i == min(same) and (i, t) not in done,
                    hashlib.sha256(t.encode()).hexdigest()))
        done.add((i, t))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(a, b, "clash", "clash") for a, b in rows], SCHEMA)


def test_against_brute_force(spark):
    got = ed.exact_groups(frame(spark, ROWS), digest=True).collect()
    assert sorted(tuple(r) for r in got) == brute(ROWS)


def test_drop_copies_keeps_columns(spark):
    kept = ed.drop_copies(frame(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "keep_id", "full"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(b[0] for b in brute(ROWS) if b[3])


def test_empty_table(spark):
    assert ed.exact_groups(frame(spark, []), digest=True).collect() == []
    assert ed.drop_copies(frame(spark, [])).collect() == []
