"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets verify every pair.

* Shingles are runs of five lower-case words (letters and digits); a text of one to four words is one shingle.
* ``bands_for`` picks the bands and rows from the threshold and a target recall.
* Texts with the same shingle set form one class, so exact copies are never paired with each other.
* Band hashes are shuffled; each bucket links its members to the smallest one (as many rows as members, no pairs).
  Connected buckets form a *neighbourhood*, which holds every pair that shares a band.
* The shingle sets of a neighbourhood meet in tiles of a bounded number of shingles.  Every pair of a neighbourhood is
  verified on the full sets in some tile, which returns one row per member: its links and the smallest member connected to it there.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowdex.llm.common import Hashes, saved, small, table, text_batches, values
from flowdex.llm.graph import connected_components

WORD = re.compile(r"[^\W_]+")
SIZE = 5                  # words in a shingle
THRESHOLD = 0.8           # Jaccard similarity from which two texts are linked
RECALL = 0.998            # wanted chance that a pair exactly at the threshold shares a band
TILE_SHINGLES = 60_000    # shingles that one side of a verification tile holds, about
WORD_CACHE = 150_000      # words whose hash a task keeps; the cache restarts beyond it


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows) with ``1 - (1 - threshold^rows)^bands >= recall``: the most rows that fit in ``max_hashes``."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            return bands, rows
    return max_hashes, 1


@lru_cache(maxsize=4)
def _coefficients(n: int):
    rng = np.random.default_rng(20240229)
    return (rng.integers(1, 2 ** 63, n, dtype=np.uint64) | np.uint64(1)), rng.integers(0, 2 ** 63, n, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Text -> sorted distinct 64-bit shingle hashes."""

    def __init__(self, size: int = SIZE):
        self.size, self.words = size, Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        found = WORD.findall((text or "").lower())
        if not found:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.words.bounded(WORD_CACHE).__getitem__, found), np.uint64, len(found))
        n = min(self.size, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i]
        return np.unique(_mix(out))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of ``rows`` MinHash values; the band's number is part of it."""
    a, b = _coefficients(bands * rows)
    low = np.full(bands * rows, np.uint32(0xFFFFFFFF), np.uint32)
    for i in range(0, len(shingles), 2048):  # bounded memory for very long texts
        part = shingles[i:i + 2048, None] * a + b
        low = np.minimum(low, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for column in low.reshape(bands, rows).T:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """``(id, key, n, bands)``: the shingle set's key and size and its band hashes; no bands for a text without words."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            keys, sizes, hashes = [], [], []
            for text in values(texts):
                s = shingler(text)
                keys.append(set_key(s))
                sizes.append(len(s))
                hashes.append(band_hashes(s, bands, rows) if len(s) else np.empty(0, np.int64))
            flat = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
            offsets = np.cumsum([0] + [len(h) for h in hashes])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))],
                names=["id", "key", "n", "bands"])

    src = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, key binary, n long, bands array<long>")


def _neighbourhoods(sets: DataFrame) -> DataFrame:
    """``(key, hood)`` of the sets that share a band with another set."""
    banded = saved(sets.select("key", F.explode("bands").alias("bucket")), "bands")
    low = saved(banded.groupBy("bucket").agg(F.min("key").alias("low"), F.count("*").alias("c")).filter("c > 1"), "low")
    edges = banded.join(low, "bucket").filter("key <> low").select(F.col("key").alias("u"), F.col("low").alias("v"))
    return connected_components(edges).select(F.col("node").alias("key"), F.col("component").alias("hood"))


def _tile_links(threshold: float):
    """Verifier of one tile: members with shingles -> links of each member, and the smallest one connected to it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("key").sort_values("key", kind="stable").reset_index(drop=True)
        m = len(pdf)
        n = pdf["n"].to_numpy(np.int64)
        side, diagonal = pdf["side"].to_numpy(), bool(pdf["i"].iloc[0] == pdf["j"].iloc[0])
        left = np.arange(m) if diagonal else np.flatnonzero(side == pdf["i"].iloc[0])
        right = left if diagonal else np.flatnonzero(side == pdf["j"].iloc[0])
        _, code = np.unique(np.concatenate(pdf["shingles"].tolist()), return_inverse=True)
        member = np.repeat(np.arange(m), n)
        order = np.argsort(code, kind="stable")
        code, member = code[order], member[order]
        both = np.zeros((len(left), len(right)), np.float32)
        place = np.zeros(m, np.int64)
        place[left] = np.arange(len(left))
        place2 = np.zeros(m, np.int64)
        place2[right] = np.arange(len(right))
        is_left, is_right = np.zeros(m, bool), np.zeros(m, bool)
        is_left[left], is_right[right] = True, True
        width = max(256, min(8192, 2_000_000 // m))
        for start in range(0, int(code[-1]) + 1, width):
            a, b = np.searchsorted(code, [start, start + width])
            c, who = code[a:b] - start, member[a:b]
            x = np.zeros((len(left), width), np.float32)
            k = is_left[who]
            x[place[who[k]], c[k]] = 1
            if diagonal:
                y = x
            else:
                y = np.zeros((len(right), width), np.float32)
                k = is_right[who]
                y[place2[who[k]], c[k]] = 1
            both += x @ y.T
        linked = both >= threshold * (n[left][:, None] + n[right][None, :] - both) - 1e-6
        if diagonal:
            np.fill_diagonal(linked, False)
        copies = pdf["copies"].to_numpy(np.int64)
        links, low = np.zeros(m, np.int64), np.arange(m)
        links[left] += linked @ copies[right]
        if not diagonal:
            links[right] += linked.T @ copies[left]
        while True:  # the smallest member that a member is connected to within this tile
            before = low.copy()
            low[left] = np.minimum(low[left], np.where(linked, low[right][None, :], m).min(axis=1, initial=m))
            low[right] = np.minimum(low[right], np.where(linked, low[left][:, None], m).min(axis=0, initial=m))
            low = low[low]
            if (low == before).all():
                break
        got = links > 0
        keys = pdf["key"].to_numpy()
        return pd.DataFrame({"key": keys[got], "links": links[got], "low": keys[low[got]]})

    return run


def _verified(docs, id_col, text_col, members, threshold) -> DataFrame:
    """``(key, links, low)`` of the members of a neighbourhood that have a verified link."""
    totals = members.groupBy("hood").agg(F.sum("n").alias("total"))
    members = (members.join(totals, "hood")
               .withColumn("blocks", F.ceil(F.col("total") / F.lit(TILE_SHINGLES)).cast("int"))
               .select("id", "key", "hood", "n", "copies", "blocks"))
    members = small(saved(members, "members"))

    def run(batches):
        shingler, sent = Shingler(), set()
        for batch in batches:
            texts = values(batch.column(batch.schema.get_field_index("text")))
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            sets = [shingler(t) for t in texts]
            # An id may repeat: its other texts don't have this key, and equal rows are sent once by each task.
            same = []
            for s, k in zip(sets, keys):
                same.append(k not in sent and set_key(s) == k)
                if same[-1]:
                    sent.add(k)
            same = pa.array(same, pa.bool_())
            offsets = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            out = pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("key", "hood", "n", "copies", "blocks")]
                + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))],
                names=["key", "hood", "n", "copies", "blocks", "shingles"])
            yield out.filter(same)

    src = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = (src.join(members, "id").mapInArrow(
        run, "key binary, hood binary, n long, copies long, blocks int, shingles array<long>")
        .withColumn("side", F.expr("cast(pmod(xxhash64(key), blocks) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "hood", "n", "copies", "side", F.least("side", "other").alias("i"),
                F.greatest("side", "other").alias("j"), "shingles"))
    return sets.groupBy("hood", "i", "j").applyInPandas(_tile_links(threshold), "key binary, links long, low binary")


def _classified(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float):
    """``sketched(id, key, n, bands)`` of all rows, and ``known(key, class_id, n_links, keep_key)`` of the sets that have
    copies or links; ``keep_key`` is the set of the class's smallest id."""
    bands, rows = bands_for(threshold, recall)
    sketched = saved(sketches(docs, id_col, text_col, bands, rows), "sketches")
    # Wordless rows leave first: their common key would gather them all.
    worded = sketched.filter("n > 0")
    sets = saved(worded.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"),
                                           F.first("n").alias("n")), "sets")
    bands_of = worded.select("key", "bands").dropDuplicates(["key"])
    hoods = _neighbourhoods(bands_of)
    members = saved(sets.join(hoods, "key"), "in_hoods")
    links = saved(_verified(docs, id_col, text_col, members, threshold), "links")
    classes = connected_components(links.select(F.col("key").alias("u"), F.col("low").alias("v")))
    classes = classes.select(F.col("node").alias("key"), "component")
    named = sets.join(classes, "key").groupBy("component").agg(
        F.min("id").alias("class_id"), F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key"))["key"].alias("keep_key"))
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    linked = saved(classes.join(named, "component").join(counted, "key").select("key", "class_id", "links", "keep_key"),
                   "classes")
    # Only sets with copies or links need a lookup; the rest answer for themselves.
    known = (sets.join(linked, "key", "left").filter("copies > 1 or links is not null")
             .select("key", F.coalesce("class_id", "id").alias("class_id"),
                     (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("keep_key", "key").alias("keep_key")))
    return sketched, saved(known, "known")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``n_links``.

    ``n_links`` counts the other rows whose shingle set has Jaccard similarity ``threshold`` or more with this row's
    (copies with an equal set included); rows connected by links share a ``class_id``, the smallest id among them.
    Null, empty and wordless texts have no shingles: each is its own class without links.  Repeated rows are copies of
    each other; null ids never name a class unless all its rows have none.  No rows give no rows; other columns are not
    read.  Ids are whole numbers.  A pair right at the threshold is missed with a chance of at most ``1 - recall``.
    """
    sketched, known = _classified(docs, id_col, text_col, threshold, recall)
    worded, known = sketched.filter("n > 0"), known.drop("keep_key")
    found = worded.select("id", "key").join(small(known), "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    alone = sketched.filter("n = 0").select(F.col("id").alias(id_col), F.col("id").alias("class_id"),
                                            F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone)


def _with_keys(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__key``, the key of each row's shingle set; all columns as they were."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            keys = [set_key(shingler(t)) for t in values(batch.column(at))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["row", "__key"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = text_batches(docs).select(row, F.col(f"`{text_col}`").cast("string").alias("__text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("__key", T.BinaryType())]))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  recall: float = RECALL) -> DataFrame:
    """``docs`` with the document of the smallest id of each class, all columns as they were.

    A row goes by its id and its text: rows that repeat an id with another text are judged by that text.  Rows that repeat
    id and shingle set of the one that stays, stay with it (exact dedup removes such rows).  A row without an id goes if a
    row with an id has its shingle set; sets that only rows without an id have aren't compared with others.
    """
    sketched, known = _classified(docs, id_col, text_col, threshold, recall)
    stays = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("keep_key"))
    gone = saved(sketched.filter("n > 0").select("id", "key").join(small(known), "key").filter(~stays)
                 .select("id", "key").distinct(), "dropped")
    # Ids that stand for several texts, and missing ones: their rows are told apart by the key, which is made again.
    several = (sketched.select("id", "key").join(gone.select("id").distinct(), "id", "left_semi").groupBy("id")
               .agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b").select("id"))
    several = saved(several, "several_texts")
    plain = gone.filter("id is not null").join(small(several), "id", "left_anti").select(
        F.col("id").alias("drop_id"), F.lit(False).alias("several"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    marks = saved(plain.distinct().unionByName(several.select(F.col("id").alias("drop_id"), F.lit(True).alias("several"))),
                  "marks")
    marked = marked.join(small(marks), F.col(f"row.`{id_col}`").cast("long") == F.col("drop_id"), "left")
    unclear = F.col("several") | (F.col(f"row.`{id_col}`").isNull() & F.lit(gone.filter("id is null").count() > 0))
    unclear = F.coalesce(unclear, F.lit(False))
    clear = marked.filter(~unclear & F.col("several").isNull()).select("row.*")
    rest = _with_keys(marked.filter(unclear).select("row.*"), text_col)
    hit = F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("id")) & (F.col("__key") == F.col("key"))
    return clear.unionByName(rest.join(small(gone), hit, "left_anti").select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"))
