import hashlib
import zlib

import pytest

from flowdex.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, idx long, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(i, source, lang, chars, text):
    return h(*map(field, (i, source, lang, chars, text)))


def tree(leaves):
    """Levels of nodes up to the top one."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 16 * 16
        out.append((i - first, level[first:first + 16]))
        i //= 16
    return out


def brute(rows):
    groups = {}
    for i, text, lang, source, chars in rows:
        shown = text
        if i is not None and text is not None and zlib.crc32(str(i).encode()) % 5 == 0:
            shown = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups.setdefault(source, []).append((i, leaf_of(i, source, lang, chars, text), leaf_of(i, source, lang, chars, shown)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree([r[1] for r in groups[s]])
    over = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for j, (i, leaf, shown) in enumerate(groups[s]):
            path = proof(trees[s], j) + proof(over, k)
            acc = shown
            for slot, family in path:
                acc = h(*family[:slot], acc, *family[slot + 1:])
            said = h(*[x for slot, family in path for x in family[:slot] + family[slot + 1:]])
            root = over[-1][0]
            out.append((i, leaf, trees[s][-1][0], root, said, acc, acc == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows], SCHEMA)


def checked(docs):
    from pyspark.sql import functions as F
    return mm.manifest(docs, tampered={"text": F.translate("text", mm.UPPER, mm.LOWER)},
                       where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


ODD = [(5000, None, None, None, None), (5001, "", "en", "", 0), (5002, "Größe ÄB", "de", "zé", 8), (5003, "X" * 200_000, None, "b", 3),
       (5004, "Same", "en", "b", 4), (5004, "Same", "en", "b", 4), (5004, "Other", "en", "b", 5), (None, "No Id", "en", "b", 5),
       (5005, "A", "en", None, 1), (5010, "no capitals", "en", "b", 3)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17}, {"a": 300, "b": 1, "c": 33, "hot": 4200}])
def test_against_brute_force(spark, sizes):
    rows = [(k * 10_000 + i, f"Text {i} Of {s}", "en", s, i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    if len(sizes) > 2:
        rows += ODD
    got = sorted((tuple(r) for r in checked(frame(spark, rows[::-1])).collect()), key=str)
    assert got == brute(rows)
    assert len(sizes) < 3 or {r[-1] for r in got} == {True, False}


def test_more_sources_than_a_family(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 40}", i) for i in range(100)]
    assert sorted((tuple(r) for r in checked(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_empty_table_and_no_python(spark):
    docs = frame(spark, ODD)
    assert mm.manifest(docs.limit(0)).collect() == []
    assert all(r.verified for r in mm.manifest(docs).collect())
    plan = checked(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
