"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one occurrence per connected group.

1. Lines are normalised (lower-case words, digits as 0, single spaces); equal ones are one *key* from here on, so a line
   that millions of documents share is one row.  Each key has a 64-bit SimHash of its words.
2. Two SimHashes that differ in at most ``BITS`` = 3 bits agree in two of five blocks.  Distinct SimHashes are shuffled on
   each pair of blocks; buckets found hot in a sample are split into tiles, so no bucket gathers in one task.  A bucket
   returns a spanning forest of its close SimHashes, at most one row per member.
3. Keys of connected SimHashes meet in tiles of bounded size; there a pair of close SimHashes is verified by edit
   similarity, unless verified pairs connect it already.  The verified links' components are the groups.
4. The first line of a group, by document and line number, is kept; lines without a word are always kept.
"""

from __future__ import annotations

from array import array
from itertools import chain, combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowdex.llm.common import BROADCAST_ROWS, saved, small, table, text_batches, values
from flowdex.llm.graph import connected_components

# Bytes of lower-case UTF-8: ASCII marks and white space other than line feeds become spaces, digits 0.
NORMAL = bytes(10 if b == 10 else 48 if 48 <= b <= 57 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
BITS = 3                       # SimHash distance up to which lines are compared
BLOCKS = (13, 13, 13, 13, 12)  # bits of the five blocks
SIMILARITY = 0.9               # edit similarity from which two lines are one
SAMPLE = 64                    # one SimHash in so many tells which buckets are hot
HOT = 16                       # ... if a bucket has at least so many of them
TILE = 1024                    # members of one side of a tile, about
WORD_CACHE = 150_000
GROUP_WORDS = 60_000           # words hashed at a time
# The bits of a byte as the bytes of a number.
COUNTERS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def edit_similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Whether ``1 - distance / longer length`` is at least ``least`` (Levenshtein distance, bit-parallel)."""
    longest = max(len(a), len(b))
    most = int((1 - least) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    cut = 0
    while cut < end - start and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    a, b = a[start:len(a) - cut], b[start:len(b) - cut]
    if not a or not b:
        return max(len(a), len(b)) <= most
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    mask, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = mask, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        x = eq | down
        d = (((x & up) + up) ^ up) | x
        right, left = down | (mask & ~(d | up)), up & d
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right = (right << 1 | 1) & mask
        up = (left << 1 & mask) | (mask & ~(d | right))
        down = right & d
    return distance <= most


def normal_lines(text: str) -> list[list[bytes]]:
    """The words of each line of a text: lower case, digits as 0, split at ASCII marks and white space."""
    return [line.split() for line in text.lower().encode().translate(NORMAL).split(b"\n")]


def line_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


class WordNumbers(dict):
    """Words numbered as they come, with their 64-bit hashes; ``bounded`` restarts it when it has grown too large."""

    def __init__(self):
        super().__init__()
        self.hashes = array("Q")

    def __missing__(self, word):
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number

    def bounded(self, most: int) -> "WordNumbers":
        if len(self) > most:
            self.clear()
            self.hashes = array("Q")
        return self


class SimHasher:
    def __init__(self):
        self.cache = WordNumbers()

    def __call__(self, lines: list[list[bytes]]) -> np.ndarray:
        """SimHashes of lines given as non-empty lists of words.

        Each distinct word of a line counts once: else the most frequent words would make long lines alike.
        """
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        numbers = np.fromiter(map(self.cache.bounded(WORD_CACHE).__getitem__, chain.from_iterable(lines)), np.int64, sizes.sum())
        words = np.sort(np.repeat(np.arange(len(lines)) << 32, sizes) | numbers)
        words = words[np.flatnonzero(np.diff(words, prepend=-1))]
        sizes = np.bincount(words >> 32, minlength=len(lines))
        h = np.frombuffer(self.cache.hashes, np.uint64)[words & 0xFFFFFFFF]
        # Eight one-byte counters are added as one number, so a longer line is counted in slices of 255 words.
        slices = -(-sizes // 255)
        first = np.cumsum(slices) - slices
        inner = np.arange(slices.sum()) - np.repeat(first, slices)
        starts = np.repeat(np.cumsum(sizes) - sizes, slices) + 255 * inner
        ones = np.add.reduceat(COUNTERS[h.view(np.uint8).reshape(-1, 8)], starts, axis=0).view(np.uint8)
        if len(ones) > len(lines):
            ones = np.add.reduceat(ones, first, axis=0, dtype=np.int32)
        return np.packbits(ones > (sizes // 2)[:, None], axis=1).view(np.int64).ravel()


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, line, key, sim)`` of every line; key and sim are null without a word; a null text has the one line -1."""

    def run(batches):
        hasher = SimHasher()
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), values(batch.column(1)))
            while True:
                doc, line, key, worded, has = [], [], [], [], []
                words = 0
                for i, text in rows:
                    if text is None:
                        doc.append(i)
                        line.append(-1)
                        key.append(None)
                        has.append(False)
                        continue
                    parts = normal_lines(text)
                    doc += [i] * len(parts)
                    line += range(len(parts))
                    for found in parts:
                        has.append(bool(found))
                        if found:
                            key.append(line_key(found))
                            worded.append(found)
                            words += len(found)
                        else:
                            key.append(None)
                    if words >= GROUP_WORDS:
                        break
                if not doc:
                    break
                sim = np.zeros(len(doc), np.int64)
                has = np.array(has, bool)
                if worded:
                    sim[has] = hasher(worded)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(line, pa.int32()), pa.array(key, pa.binary()),
                     pa.array(sim, pa.int64(), mask=~has)], names=["doc", "line", "key", "sim"])

    src = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc long, line int, key binary, sim long")


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member that each of ``n`` members is connected to by the pairs ``(i, j)``."""
    root = np.arange(n)
    while len(i):
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            break
    return root


def _close(bucket: np.ndarray, sim: np.ndarray, side: np.ndarray | None = None, cross: np.ndarray | None = None):
    """Pairs of one bucket within ``BITS``; rows are sorted by bucket.  A cross tile pairs its two sides alone."""
    left, right = [], []
    at, d = np.arange(len(bucket) - 1), 1
    while len(at):
        at = at[at + d < len(bucket)]
        at = at[bucket[at] == bucket[at + d]]
        if not len(at):
            break
        near = at[np.bitwise_count((sim[at] ^ sim[at + d]).view(np.uint64)) <= BITS]
        if side is not None:
            near = near[~cross[near] | (side[near] != side[near + d])]
        left.append(near)
        right.append(near + d)
        d += 1
    empty = np.empty(0, np.int64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


def _close_sims(sims: DataFrame) -> DataFrame:
    """``(u, v)``: a spanning forest of the SimHashes that are connected by distances up to ``BITS``."""
    shifts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]

    def block(k):
        return F.shiftrightunsigned("sim", shifts[k]).bitwiseAND(F.lit((1 << BLOCKS[k]) - 1))

    buckets = F.array(*[F.lit(n << 40).bitwiseOR(F.shiftleft(block(a), 16)).bitwiseOR(block(b))
                        for n, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))])
    rows = sims.select("sim", F.explode(buckets).alias("bucket"))
    # Buckets that hold many SimHashes are split; which ones are, changes the tiles only, never the pairs.
    hot = (sims.filter(F.pmod(F.xxhash64("sim"), F.lit(SAMPLE)) == 0).select("sim", F.explode(buckets).alias("bucket"))
           .groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") >= HOT)
           .select("bucket", F.ceil(F.col("n") * SAMPLE / TILE).cast("int").alias("blocks")))
    hot = saved(hot, "hot_buckets")
    plain, tiles = rows, None
    if hot.count():
        plain = rows.join(small(hot), "bucket", "left_anti")
        tiles = (rows.join(small(hot), "bucket")
                 .withColumn("side", F.pmod(F.xxhash64("sim", F.lit(1)), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select(F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other")).alias("bucket"),
                         "sim", "side", (F.col("side") != F.col("other")).alias("cross"),
                         F.least("side", "other").alias("low")))
        # A tile of two blocks pairs rows of different sides only.
        low, high = F.col("low"), F.col("side")
        tiles = tiles.select("bucket", "sim", F.when(high == low, 0).otherwise(1).alias("side"), "cross")

    def run(batches):
        held = []

        def flush(b, s, side=None, cross=None):
            order = np.lexsort((s, b))
            b, s = b[order], s[order]
            same = np.zeros(len(b), bool)
            same[1:] |= b[1:] == b[:-1]
            same[:-1] |= b[1:] == b[:-1]
            b, s = b[same], s[same]
            if not len(b):
                return None
            i, j = _close(b, s) if side is None else _close(b, s, side[order][same], cross[order][same])
            root = _roots(len(b), i, j)
            link = np.flatnonzero(s[root] != s)
            return pa.RecordBatch.from_arrays([pa.array(s[link]), pa.array(s[root[link]])], names=["u", "v"])

        for batch in batches:
            got = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                got = [np.concatenate([a, b]) for a, b in zip(held, got)]
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(got[0], got[0][-1], "left")) if len(got[0]) else 0
            if cut:
                out = flush(*[x[:cut] for x in got])
                if out is not None and out.num_rows:
                    yield out
            held = [x[cut:] for x in got]
        if held and len(held[0]):
            out = flush(*held)
            if out is not None and out.num_rows:
                yield out

    def found(df):
        return df.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "u long, v long")

    plain = found(plain.select("bucket", "sim"))
    return plain if tiles is None else plain.unionByName(found(tiles))


def _verified(members: list[tuple], cross: bool) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the verified pairs of one tile's ``(key, sim, text, side)``."""
    members = sorted({m[0]: m for m in members}.values(), key=lambda m: m[1])
    n = len(members)
    bits = [m[1] & (1 << 64) - 1 for m in members]
    wide = np.array(bits, np.uint64) if n > 64 else None
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for a in range(n - 1):
        if wide is None:
            near = [b for b in range(a + 1, n) if (bits[a] ^ bits[b]).bit_count() <= BITS]
        else:
            near = (np.flatnonzero(np.bitwise_count(wide[a + 1:] ^ wide[a]) <= BITS) + a + 1).tolist()
        for b in near:
            if cross and members[a][3] == members[b][3]:
                continue
            x, y = find(a), find(b)
            if x != y and edit_similar(members[a][2], members[b][2]):
                root[y] = x
                edges.append((members[a][0], members[b][0]))
    return edges


def _verify(batches):
    """Links of sorted tiles: rows ``set, i, j, key, sim, text, side``; a tile may go on in the next batch."""
    tile, held = None, []
    for batch in batches:
        edges = []
        rows = zip(*(c.to_pylist() for c in batch.columns))
        for at, group in groupby(rows, key=lambda r: r[:3]):
            if at != tile:
                if held:
                    edges += _verified(held, tile[1] != tile[2])
                tile, held = at, []
            held += [r[3:] for r in group]
        yield _edges(edges)
    if held:
        yield _edges(_verified(held, tile[1] != tile[2]))


def _edges(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], names=["u", "v"])


def line_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, line, kept)`` of every line of ``docs`` (a null text: the one line -1, kept).

    Lines are split at line feeds.  Lines without a word are kept; of the lines of a group the first by document and
    number is kept.  Rows that repeat an id share their decisions on equal lines.  Null ids come after all others.
    """
    return _judged(docs, id_col, text_col).select("doc", "line", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``line_groups`` with each line's ``key`` (null without a word)."""
    lines = saved(line_table(docs, id_col, text_col), "lines")
    worded = lines.filter("key is not null")
    keys = saved(worded.groupBy("key", "sim").agg(F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "line"))
                                                  .alias("first"), F.count("*").alias("n")), "keys")
    per_sim = saved(keys.groupBy("sim").agg(F.count("*").alias("n")), "sims")
    edges = saved(_close_sims(per_sim.select("sim")), "close")
    groups = connected_components(edges).select(F.col("node").alias("sim"), F.col("component").alias("set"))
    alone = (per_sim.filter("n > 1").join(groups, "sim", "left_anti")).select("sim", F.col("sim").alias("set"))
    groups = saved(groups.unionByName(alone), "sets")  # SimHashes that more than one key is close to
    members = keys.join(groups, "sim").select("key", "sim", "set", "first.doc", "first.line")
    sizes = members.groupBy("set").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    members = saved(members.join(sizes, "set"), "members")
    wanted = members.groupBy("doc").agg(F.collect_list(F.struct("line", "key", "sim", "set", "blocks")).alias("wanted"))
    if members.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def texts(batches):
        sent = set()
        for batch in batches:
            out = []
            for text, rows in zip(values(batch.column(0)), values(batch.column(1))):
                parts = normal_lines(text or "")
                for r in rows:
                    words = parts[r["line"]] if r["line"] < len(parts) else []
                    if r["key"] not in sent and line_key(words) == r["key"]:  # an id may repeat with other texts
                        sent.add(r["key"])
                        out.append((r["key"], r["sim"], r["set"], r["blocks"], b" ".join(words).decode()))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                names=["key", "sim", "set", "blocks", "text"])

    src = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tiles = (src.join(wanted, F.col("id").eqNullSafe(F.col("doc"))).select("text", "wanted")
             .mapInArrow(texts, "key binary, sim long, set long, blocks int, text string")
             .withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("set", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                     "key", "sim", "text", "side"))
    links = (tiles.repartition("set", "i", "j").sortWithinPartitions("set", "i", "j")
             .mapInArrow(_verify, "u binary, v binary"))
    classes = connected_components(links).select(F.col("node").alias("key"), "component")
    firsts = saved(classes.join(keys, "key"), "classes")
    best = firsts.groupBy("component").agg(F.min("first").alias("keep"))
    linked = firsts.join(best, "component").select("key", "keep")
    # Keys with one line and no link keep it: only the others are looked up.
    repeated = keys.filter("n > 1").join(classes, "key", "left_anti").select("key", F.col("first").alias("keep"))
    known = saved(linked.unionByName(repeated).select("key", F.col("keep.doc").alias("keep_doc"),
                                                      F.col("keep.line").alias("keep_line")), "kept")
    found = worded.join(small(known), "key", "left")
    kept = F.col("keep_line").isNull() | (F.col("doc").eqNullSafe(F.col("keep_doc")) & (F.col("line") == F.col("keep_line")))
    return (found.select("doc", "line", kept.alias("kept"), "key")
            .unionByName(lines.filter("key is null").select("doc", "line", F.lit(True).alias("kept"), "key")))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per id: ``n_lines``, ``n_kept`` and ``dropped`` (line numbers, ascending; from 0).

    A null text has no lines, an empty one has one.  No rows give no rows; other columns are not read.
    """
    lines = line_groups(docs, id_col, text_col).distinct()
    return lines.groupBy(F.col("doc").alias(id_col)).agg(
        F.count(F.when(F.col("line") >= 0, 1)).alias("n_lines"),
        F.count(F.when((F.col("line") >= 0) & F.col("kept"), 1)).alias("n_kept"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col("line")))).alias("dropped"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines removed from the text; all rows and columns stay (a null text stays null).

    A line goes by its document, number and words: rows that repeat an id with other texts lose only lines of their own.
    """
    drops = _judged(docs, id_col, text_col).filter("not kept").select("doc", "line", "key").distinct()
    drops = saved(drops.groupBy(F.col("doc").alias("drop_id")).agg(F.collect_list(F.struct("line", "key")).alias("dropped")),
                  "drops")

    def run(batches):
        for batch in batches:
            texts = []
            for text, gone in zip(values(batch.column(1)), values(batch.column(2))):
                if text is not None and gone:
                    gone = {(g["line"], g["key"]) for g in gone}
                    keys = [line_key(w) if w else None for w in normal_lines(text)]
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if (i, keys[i]) not in gone)
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "new"])

    rows = text_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(drops, F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("drop_id")), "left")
    out = joined.select("row", F.col(f"row.`{text_col}`").cast("string").alias("text"), "dropped").mapInArrow(
        run, T.StructType([rows.schema["row"], T.StructField("new", T.StringType())]))
    return out.select(*[F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents"))
