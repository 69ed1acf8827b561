"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller id.

Suffixes are sparse.  Of every 50-byte string the *anchor* is its 18-byte gram with the smallest hash (the first of equal
ones): equal strings have equal anchors at equal places.  Neighbouring strings mostly share theirs, so a text has one
anchor in about 16 bytes, and the strings of an anchor are one *slice* of about 65 bytes.

1. Whole documents are packed into compressed batches of some megabytes, kept in a table bucketed by batch: later joins
   with it move no text.
2. The distinct anchor hashes of each batch meet by hash range.  A hash that is in one document alone can't be repeated;
   what comes back to the batch is one bit for each hash.  A second bit marks hashes that very many batches have.
3. Sampled splitters range-partition the remaining suffixes by their leading bytes at the anchor.  Equal slices of a batch
   travel once, with their smallest and largest document, so a string that all documents share is one entry a batch.  Of
   marked anchors each string travels by itself and is partitioned by its own leading bytes: a common phrase in ever new
   surroundings is spread by them.
4. A partition sorts its suffixes at their anchors, compares neighbours to find where groups of equal anchors begin and
   end, and sorts the strings of each group by multikey quicksort: eight bytes at a time, going on only with groups that
   still hold two documents.  A splitter never cuts suffixes with equal leading bytes, so no group crosses a partition's
   boundary; the pieces that a partition is sorted in are cut between groups alone.
5. Strings with a smaller document go back to their batches, which cover their bytes.

Hashes decide only what is compared, never what is equal.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowdex.llm.common import saved, table, text_batches, values
from flowdex.session import work_dir

LEAST = 50               # bytes of a string
GRAM = 18                # bytes of an anchor
BATCH = 4 << 20          # bytes of text in a batch, about; a longer document is a batch of its own
BUCKET = 16              # batches in a bucket of their table, about
PIECE = 1 << 18          # bytes hashed at a time
HASHES = 1 << 20         # anchor hashes compared by one task, about
ENTRIES = 100_000        # slices sorted by one task, about
WINDOWS = 500_000        # strings sorted at a time, unless one group has more
HOT = 1000               # batches from which an anchor is hot
SAMPLE_BATCHES, SAMPLE_TOKENS = 64, 2000   # batches that splitters are drawn from, about, and tokens of each, at most
WORDS = (*range(0, LEAST - 7, 8), LEAST - 8)  # where the eight-byte words of a string begin
MULTIPLIER = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))


def gram_hashes(part: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes from each place on: polynomial hashes of 1, 2, 4... bytes, put together."""
    now, size, out, have, left = BYTES[part], 1, None, 0, GRAM
    while left:
        if left & 1:
            power = np.uint64(pow(MULTIPLIER, size, 1 << 64))
            if out is None:
                out = now
            else:
                ahead = now[have:]
                n = min(len(out), len(ahead))
                out = out[:n] * power + ahead[:n]
            have += size
        left >>= 1
        if left:
            now = now[:-size] * np.uint64(pow(MULTIPLIER, size, 1 << 64)) + now[size:]
            size *= 2
    return _mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:have - width], x[width - have:]) if have < width else x


class Texts:
    """One batch: the bytes of its documents one after the other, their ids and ends."""

    def __init__(self, row: dict):
        self.batch = row["batch"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)

    def slices(self):
        """Slices in order of place: first string, number of strings, anchor, anchor's hash, document number."""
        buf, n = self.buf, len(self.buf)
        valid = np.ones(n, bool)
        last = (self.ends[:, None] - 1 - np.arange(LEAST - 1)).ravel()
        valid[last[last >= 0]] = False
        for k in np.flatnonzero(~self.known):
            valid[self.ends[k] - self.sizes[k]:self.ends[k]] = False
        got = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]]
        low = np.uint64((1 << (PIECE + LEAST).bit_length()) - 1)
        for s in range(0, n - LEAST + 1, PIECE):
            part = buf[s:s + PIECE + LEAST - 1]
            h = gram_hashes(part)
            key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
            at = (sliding_min(key, LEAST - GRAM + 1) & low).astype(np.int64)
            v = valid[s:s + len(at)]
            edge = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (v[1:] != v[:-1])]))
            size = np.diff(np.append(edge, len(at)))
            edge, size = edge[v[edge]], size[v[edge]]
            for out, x in zip(got, (edge + s, size, at[edge] + s, h[at[edge]])):
                out.append(x)
        start, size, at, h = map(np.concatenate, got)
        return start, size, at, h, np.searchsorted(self.ends, start, "right")


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, n: int, kinds) -> list[np.ndarray]:
    """Arrays of ``n`` values of each kind, then the bytes that are left."""
    data, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out + [np.frombuffer(data, np.uint8, -1, at)]


def _rows(batch: pa.RecordBatch):
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows begins."""
    n = len(sorted_columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


BATCH_SCHEMA = "batch long, ids binary, known binary, sizes binary, bytes long, text binary"


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``BATCH_SCHEMA`` rows of whole documents; a null text is empty."""

    def run(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def out():
            ids = np.array([i or 0 for i, _ in held], np.int64)
            known = np.array([i is not None for i, _ in held], bool)
            sizes = np.array([len(t) for _, t in held], np.int64)
            text = zstandard.ZstdCompressor(level=1).compress(b"".join(t for _, t in held))
            return pa.RecordBatch.from_pydict({
                "batch": pa.array([number], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                "known": pa.array([known.tobytes()], pa.binary()), "sizes": pa.array([sizes.tobytes()], pa.binary()),
                "bytes": pa.array([size], pa.int64()), "text": pa.array([text], pa.binary())})

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), values(batch.column(1))):
                held.append((i, t or b""))
                size += len(held[-1][1])
                if size >= BATCH:
                    yield out()
                    held, size, number = [], 0, number + 1
        if held:
            yield out()

    src = text_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"),
                                    F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return src.mapInArrow(run, BATCH_SCHEMA)


def bucketed(df: DataFrame, name: str, key: str, least: int) -> DataFrame:
    """``df`` as a table in the shared folder whose rows lie by ``key`` in at least so many buckets, so that joins on it
    leave them in place."""
    spark = df.sparkSession
    # Fewer buckets than a shuffle would have partitions, and the planner would shuffle this side too.
    buckets = max(least, *(int(spark.conf.get(k, "1")) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")))
    held = f"flowdex_{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, key).option("path", work_dir(spark, "llm", name)).option("compression", "none")
     .format("parquet").saveAsTable(held))
    return spark.table(held)


def _sets(h: np.ndarray, doc: np.ndarray):
    """Distinct hashes in order, and whether more than one document of the batch has it."""
    if not len(h):
        return h, np.empty(0, bool)
    order = np.argsort(h, kind="stable")
    heads = _heads(h[order])
    low, high = np.minimum.reduceat(doc[order], heads), np.maximum.reduceat(doc[order], heads)
    return h[order][heads], low < high


def shared_anchors(batches: DataFrame, buckets: int, hot: int) -> DataFrame:
    """``(batch, bucket, keep, hot, kept)``: bits for the batch's distinct hashes of each hash range."""

    def sets(arrow):
        for rows in arrow:
            for row in _rows(rows):
                t = Texts(row)
                *_, h, doc = t.slices()
                u, many = _sets(h, t.ids[doc])
                where = ((u >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                heads = _heads(where) if len(u) else np.empty(0, np.int64)
                ends = np.append(heads, len(u))
                cut = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([int(where[c.start]) for c in cut], pa.int32()),
                    "batch": pa.array([t.batch] * len(cut), pa.int64()),
                    "hashes": pa.array([u[c].tobytes() for c in cut], pa.binary()),
                    "many": pa.array([np.packbits(many[c]).tobytes() for c in cut], pa.binary())})

    def compare(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
        sizes = [len(x) for x in lists]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
                               for x, n in zip(group["many"].to_pylist(), sizes)])
        every = np.concatenate(lists)
        order = np.argsort(every, kind="stable")
        heads = _heads(every[order])
        counts = np.diff(np.append(heads, len(every)))
        times = np.empty(len(every), np.int64)
        times[order] = np.repeat(counts, counts)
        keep, often = (times > 1) | many, times >= hot
        ends = np.cumsum([0] + sizes)
        cut = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({
            "batch": group["batch"], "bucket": group["bucket"],
            "keep": pa.array([np.packbits(keep[c]).tobytes() for c in cut], pa.binary()),
            "hot": pa.array([np.packbits(often[c]).tobytes() for c in cut], pa.binary()),
            "size": pa.array(sizes, pa.int32()), "kept": pa.array([int(keep[c].sum()) for c in cut], pa.int64())})

    return (batches.mapInArrow(sets, "bucket int, batch long, hashes binary, many binary").groupBy("bucket")
            .applyInArrow(compare, "batch long, bucket int, keep binary, hot binary, size int, kept long"))


WIDEST = 8 * -(-(2 * LEAST - GRAM) // 8)   # bytes of the longest slice, in whole words


def equal_slices(data: np.ndarray, start: np.ndarray, size: np.ndarray, off: np.ndarray):
    """Slices of equal content -> (one of each class, all in order of class, where classes begin in that order).

    ``data`` goes on for ``WIDEST`` bytes behind the last slice.  A hash proposes, a comparison decides.
    """
    n, columns = len(start), np.arange(WIDEST)
    odd = _mix(np.arange(1, WIDEST // 8 + 1, dtype=np.uint64)) | np.uint64(1)
    key = np.empty(n, np.uint64)
    pieces = [slice(a, a + 16384) for a in range(0, n, 16384)]
    for part in pieces:
        rows = data[start[part, None] + columns]
        rows[columns >= (size[part] + LEAST - 1)[:, None]] = 0
        words = rows.view(np.uint64)
        key[part] = (_mix(words * odd) + _mix(words ^ odd)).sum(axis=1, dtype=np.uint64) \
            + _mix((size[part] * 64 + off[part]).astype(np.uint64))
    order = np.argsort(key, kind="stable")
    heads = _heads(key[order])
    cls = np.empty(n, np.int64)
    cls[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    first = order[heads]
    odd_ones = []
    for part in pieces:
        rep = first[cls[part]]
        other = np.flatnonzero(rep != np.arange(n)[part])  # a class's first slice equals itself
        mine, rep = np.arange(n)[part][other], rep[other]
        same = (size[mine] == size[rep]) & (off[mine] == off[rep])
        same &= ((data[start[mine, None] + columns] == data[start[rep, None] + columns])
                 | (columns >= (size[mine] + LEAST - 1)[:, None])).all(axis=1)
        odd_ones.append(mine[~same])
    odd_ones = np.concatenate(odd_ones) if odd_ones else np.empty(0, np.int64)
    if len(odd_ones):
        cls[odd_ones] = len(first) + np.arange(len(odd_ones))
        first = np.append(first, odd_ones)
        order = np.argsort(cls, kind="stable")
    return first, order, _heads(cls[order])


class Entries:
    """The slices of a batch that may repeat, and their classes of equal content."""

    def __init__(self, row: dict):
        self.texts = t = Texts(row)
        start, size, at, h, doc = t.slices()
        bits = {"keep": [], "hot": []}
        for part in sorted(row["bits"] or [], key=lambda p: p["bucket"]):
            for k, out in bits.items():
                out.append(np.unpackbits(np.frombuffer(part[k], np.uint8), count=part["size"]).astype(bool))
        u, _ = _sets(h, t.ids[doc])
        place = np.searchsorted(u, h)
        keep, often = (np.concatenate(x)[place] if x else np.zeros(len(h), bool) for x in bits.values())
        plain, single = keep & ~often, np.flatnonzero(keep & often)
        # Of a hot anchor every string is an entry of its own, and its own anchor.
        inner = np.arange(size[single].sum()) - np.repeat(np.cumsum(size[single]) - size[single], size[single])
        alone = np.repeat(start[single], size[single]) + inner
        self.start = np.concatenate([start[plain], alone])
        self.size = np.concatenate([size[plain], np.ones(len(alone), np.int64)])
        self.off = np.concatenate([(at - start)[plain], np.zeros(len(alone), np.int64)])
        self.doc = t.ids[np.concatenate([doc[plain], np.repeat(doc[single], size[single])])]
        self.data = np.concatenate([t.buf, np.zeros(WIDEST, np.uint8)])
        self.first, self.order, self.heads = equal_slices(self.data, self.start, self.size, self.off)

    def token(self) -> np.ndarray:
        """The eight bytes at the anchor of each class, as a number that sorts as they do."""
        return _words(self.data)[(self.start + self.off)[self.first]]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, as numbers that sort as they do; nothing is copied."""
    return np.ndarray((max(0, len(data) - 7),), ">u8", data, strides=(1,))


ENTRY = (np.uint32, np.uint8, np.uint8, np.int64, np.int64)   # class, strings, anchor's place, smallest, largest document
MARK = (np.uint32, np.uint8, np.uint8, np.int64)              # class, first and last string, smallest document


def suffixes(joined: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``(part, batch, n, entries)``: each batch's classes of slices, by range of their leading bytes."""

    def run(arrow):
        for rows in arrow:
            for row in _rows(rows):
                e = Entries(row)
                if not len(e.first):
                    continue
                low = np.minimum.reduceat(e.doc[e.order], e.heads)
                high = np.maximum.reduceat(e.doc[e.order], e.heads)
                part = np.searchsorted(splitters, e.token(), "right")
                order = np.argsort(part, kind="stable")
                heads = np.append(_heads(part[order]), len(order))
                out = {"part": [], "n": [], "entries": []}
                for a, b in zip(heads[:-1], heads[1:]):
                    c = order[a:b]
                    k = e.first[c]
                    size = e.size[k] + LEAST - 1
                    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    out["part"].append(int(part[c[0]]))
                    out["n"].append(len(c))
                    out["entries"].append(_squeeze(c.astype(np.uint32), e.size[k].astype(np.uint8), e.off[k].astype(np.uint8),
                                                   low[c], high[c], e.data[np.repeat(e.start[k], size) + inner]))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(out["part"], pa.int32()), "batch": pa.array([row["batch"]] * len(out["n"]), pa.int64()),
                    "n": pa.array(out["n"], pa.int64()), "entries": pa.array(out["entries"], pa.binary())})

    return joined.mapInArrow(run, "part int, batch long, n long, entries binary")


def multikey_sort(words: np.ndarray, start: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Strings that begin at ``start`` -> (those whose equals hold two documents, the smallest document of each).

    Strings of a group are sorted by one word after the other.  A group that is down to one string is done, and after each
    word only groups that still hold two documents go on.
    """
    live, out = np.arange(len(start)), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for w in (None, *WORDS):
        keys = (group,) if w is None else (words[start[live] + w], group)
        order = np.lexsort(keys)
        live, keys = live[order], [k[order] for k in keys]
        heads = _heads(*keys)
        counts = np.diff(np.append(heads, len(live)))
        smallest = np.minimum.reduceat(low[live], heads)
        two = smallest < np.maximum.reduceat(high[live], heads)
        done = two & (counts == 1) if w != WORDS[-1] else two
        every = np.repeat(done, counts)
        out.append((live[every], np.repeat(smallest, counts)[every]))
        go = np.repeat(two & ~done, counts)
        live, group = live[go], np.repeat(np.arange(len(heads)), counts)[go]
        if not len(live):
            break
    return tuple(map(np.concatenate, zip(*out)))


def _compare(group: pa.Table) -> pa.Table:
    """Marks of one partition: strings of a slice that start in a document smaller than the slice's largest one."""
    ns = group["n"].to_pylist()
    parts = [_unpack(x, n, ENTRY) for x, n in zip(group["entries"].to_pylist(), ns)]
    cls, size, off, low, high, data = (np.concatenate([p[k] for p in parts]) for k in range(6))
    size, off = size.astype(np.int64), off.astype(np.int64)
    row = np.repeat(np.arange(len(ns)), ns)
    begin = np.cumsum(size + LEAST - 1) - (size + LEAST - 1)
    data = np.concatenate([data, np.zeros(WIDEST, np.uint8)])
    # Slices that batches share are sorted once.
    first, members, places = equal_slices(data, begin, size, off)
    least, most = np.minimum.reduceat(low[members], places), np.maximum.reduceat(high[members], places)
    words = _words(data)
    at = (begin + off)[first]
    keys = [words[at + w] for w in (*range(0, GRAM - 7, 8), GRAM - 8)]
    order = np.lexsort(keys[::-1])
    heads = _heads(*(k[order] for k in keys))
    counts = np.diff(np.append(heads, len(order)))
    go = np.minimum.reduceat(least[order], heads) < np.maximum.reduceat(most[order], heads)
    order, number = order[np.repeat(go, counts)], np.repeat(np.cumsum(go) - 1, counts)[np.repeat(go, counts)]
    # Pieces of whole groups, of about WINDOWS strings.
    strings = size[first[order]]
    piece = (np.cumsum(strings) - strings) // WINDOWS
    piece = piece[np.searchsorted(number, number, "left")] if len(number) else piece
    edges = np.append(_heads(piece), len(order)) if len(order) else [0]
    found = [[np.empty(0, np.int64)] for _ in range(3)]
    ends = np.append(places, len(members))
    for a, b in zip(edges[:-1], edges[1:]):
        mine, n = order[a:b], strings[a:b]
        kind = np.repeat(mine, n)
        inner = np.arange(len(kind)) - np.repeat(np.cumsum(n) - n, n)
        same = np.repeat(number[a:b], n) * 64 + off[first[kind]] - inner
        live, smallest = multikey_sort(words, begin[first[kind]] + inner, same, least[kind], most[kind])
        # Every slice of the class that has a later document gets the string's smallest one.
        kind, inner = kind[live], inner[live]
        counts = ends[kind + 1] - ends[kind]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        entry = members[np.repeat(ends[kind], counts) + step]
        inner, smallest = np.repeat(inner, counts), np.repeat(smallest, counts)
        hit = smallest < high[entry]
        for out, x in zip(found, (entry, inner, smallest)):
            out.append(x[hit])
    entry, inner, smallest = map(np.concatenate, found)
    order = np.lexsort((inner, entry))
    entry, inner, smallest = entry[order], inner[order], smallest[order]
    # Strings one after the other with the same smallest document are one mark.
    heads = _heads(entry, inner - np.arange(len(inner)), smallest) if len(entry) else np.empty(0, np.int64)
    last = np.append(heads[1:], len(entry)) - 1 if len(heads) else heads
    entry, first, last, smallest = entry[heads], inner[heads], inner[last], smallest[heads]
    order = np.argsort(row[entry], kind="stable")
    entry, first, last, smallest = entry[order], first[order], last[order], smallest[order]
    edges = np.append(_heads(row[entry]), len(entry)) if len(entry) else [0]
    cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
    batch = group["batch"].to_pylist()
    return pa.table({
        "batch": pa.array([batch[row[entry[c.start]]] for c in cut], pa.int64()),
        "n": pa.array([c.stop - c.start for c in cut], pa.int64()),
        "marks": pa.array([_squeeze(cls[entry[c]], first[c].astype(np.uint8), last[c].astype(np.uint8), smallest[c])
                           for c in cut], pa.binary())})


def covered(e: Entries, marks: list[dict]) -> np.ndarray:
    """Which bytes of a batch are removed."""
    n = len(e.texts.buf)
    ends = np.append(e.heads, len(e.order))
    begins, stops = [], []
    for m in marks:
        cls, first, last, smallest, _ = _unpack(m["marks"], m["n"], MARK)
        cls = cls.astype(np.int64)
        counts = ends[cls + 1] - ends[cls]
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        entry = e.order[np.repeat(ends[cls], counts) + inner]
        later = e.doc[entry] > np.repeat(smallest, counts)
        start = e.start[entry[later]]
        begins.append(start + np.repeat(first, counts)[later])
        stops.append(start + np.repeat(last, counts)[later] + LEAST)
    change = np.bincount(np.concatenate(begins), minlength=n + 1) - np.bincount(np.concatenate(stops), minlength=n + 1)
    return np.cumsum(change[:-1]) > 0


def _cleaned(arrow):
    """Documents of joined batches with their spans and the bytes that stay."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for rows in arrow:
        for row in _rows(rows):
            if row["marks"]:
                e = Entries(row)
                t, gone = e.texts, covered(e, row["marks"])
            else:
                t = Texts(row)
                gone = np.zeros(len(t.buf), bool)
            held, size = [], 0
            for k, end in enumerate(t.ends.tolist()):
                begin = end - int(t.sizes[k])
                mine, spans = gone[begin:end], []
                kept = t.buf[begin:end]
                if mine.any():
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                    spans = [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()]
                    kept = kept[~mine]
                held.append((int(t.ids[k]) if t.known[k] else None, end - begin, spans, kept.tobytes()))
                size += len(held[-1][-1])
                if size >= PIECE or k + 1 == len(t.ends):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, y) for x, y in zip(zip(*held), (pa.int64(), pa.int64(), kind, pa.binary()))],
                        names=["id", "n_bytes", "spans", "kept"])
                    held, size = [], 0


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``spans`` and ``kept``.

    ``spans`` are the maximal runs ``(start, end)`` of bytes, ascending, that are covered by a string of ``LEAST`` bytes
    which also starts in a row with a smaller id; ``kept`` is the rest of the text's UTF-8 bytes (it may cut a character).
    Null texts count as empty.  Rows with the same id don't repeat each other, whether equal or not.  Rows with a null id
    stay whole and make nobody else's bytes repeated.  Repeats within a document stay.  No rows give no rows; other
    columns aren't read; ids are whole numbers.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    batches = bucketed(packed(docs, id_col, text_col), "batches", "batch", total // (BUCKET * BATCH))
    hash_buckets = max(1, -(-total // (16 * HASHES)))
    bits = saved(shared_anchors(batches, hash_buckets, hot), "bits")
    kept = bits.agg(F.sum("kept")).first()[0] or 0
    splitters = _splitters(batches, batches.count(), max(1, -(-kept // ENTRIES)))
    mine = bits.filter("kept > 0 or size > 0").groupBy("batch").agg(
        F.collect_list(F.struct("bucket", "keep", "hot", "size")).alias("bits"))
    joined = batches.join(mine.hint("shuffle_hash"), "batch")
    marks = saved(suffixes(joined, splitters).groupBy("part").applyInArrow(_compare, "batch long, n long, marks binary"),
                  "marks")
    marks = marks.groupBy("batch").agg(F.collect_list(F.struct("n", "marks")).alias("marks"))
    # Bits are needed only where there are marks.
    said = mine.join(marks.hint("shuffle_hash"), "batch")
    out = batches.join(said.hint("shuffle_hash"), "batch", "left").mapInArrow(
        _cleaned, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


def _splitters(batches: DataFrame, n: int, parts: int) -> np.ndarray:
    """At most ``parts - 1`` leading words that cut a sample of the suffixes into equal parts."""
    if parts < 2:
        return np.empty(0, np.uint64)

    def run(arrow):
        for rows in arrow:
            for row in _rows(rows):
                t = Texts(row)
                _, _, at, _, _ = t.slices()
                words = _words(np.concatenate([t.buf, np.zeros(8, np.uint8)]))[at].astype(np.uint64)
                words = np.sort(words)[::max(1, -(-len(words) // SAMPLE_TOKENS))]
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64))], names=["token"])

    some = batches.filter(F.pmod(F.xxhash64("batch"), F.lit(max(1, n // SAMPLE_BATCHES))) == 0)
    tokens = np.sort(np.array([r[0] for r in some.mapInArrow(run, "token long").collect()], np.int64).view(np.uint64))
    if not len(tokens):
        return np.empty(0, np.uint64)
    return np.unique(tokens[np.arange(1, parts) * len(tokens) // parts])


def query(spark, sf_dir: str) -> DataFrame:
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeated_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, strlen(coalesce(text, '')) n from documents),
w as (select doc_id, p, substr(h, 2 * p + 1, {2 * LEAST}) s
      from (select doc_id, h, unnest(range(greatest(n - {LEAST - 1}, 0))) p from d)),
f as (select s, min(doc_id) lo from w group by s),
hit as (select doc_id, p from w join f using (s) where lo < doc_id),
run as (select doc_id, p, coalesce(p - lag(p) over (partition by doc_id order by p) > {LEAST}, true) fresh from hit),
span as (select doc_id, min(p) a, max(p) + {LEAST} b from (
           select doc_id, p, sum(fresh::int) over (partition by doc_id order by p) g from run) group by doc_id, g),
per as (select doc_id, sum(b - a) gone, count(*) spans, list(a order by a) starts, list(b order by a) ends
        from span group by doc_id),
piece as (select d.doc_id, unnest(range(coalesce(spans, 0) + 1)) k, h, n, starts, ends from d left join per using (doc_id)),
kept as (select doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by k) h from (
           select doc_id, k, h, case when k = 0 then 0 else ends[k] end a, coalesce(starts[k + 1], n) b from piece) group by doc_id)
select d.doc_id, n n_bytes, coalesce(gone, 0)::bigint n_removed, coalesce(spans, 0)::bigint n_spans,
       sha256(unhex(kept.h)) kept_sha256
from d left join per using (doc_id) join kept using (doc_id)
"""
