"""Reader of a sentencepiece BPE model and its encoder, with byte offsets (a small helper of ``piece_codec``).

The file is a public protocol-buffer format: field 1 repeats the pieces (1 text, 2 score, 3 type), field 2 holds the
trainer's settings (3 model type, 24 white space as suffix, 35 byte fallback), field 3 the normaliser (2 compiled
character map, 3 dummy prefix, 4 remove extra white space, 5 escape white space).
"""

from __future__ import annotations

import heapq
import math
import re
import struct

import numpy as np

# Fixed values of the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁"
LATIN, MARKS = "A-Za-zÀ-ÖØ-öø-ʯ", r"!-/:-@\[-`{-~\n"   # characters, as regular expressions write them
CHUNK_CACHE = 600_000   # chunks whose ids a task keeps; the cache restarts beyond it


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at:at + n], at + n
        else:
            n = 4 if kind == 5 else 8
            value, at = data[at:at + n], at + n
        yield tag >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie of source prefixes and the NUL-ended texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size:] if size else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest source prefix of ``data[at:]``, or None."""
        units, found = self.units, None
        node = self._child(units[0])
        for i in range(at, len(data)):
            byte = data[i]
            if byte == 0:
                break
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[start:self.texts.index(b"\0", start)]
        return found

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class PieceModel:
    def __init__(self, data: bytes):
        pieces, scores, kinds, blob = [], [], [], b""
        kind_of_model, suffix, self.fallback = 1, 0, 0
        self.prefix = self.squeeze = self.escape = 1
        for field, value in _fields(data):
            if field == 1:
                piece, score, kind = b"", 0.0, NORMAL
                for f, v in _fields(value):
                    if f == 1:
                        piece = v
                    elif f == 2:
                        score = struct.unpack("<f", v)[0]
                    elif f == 3:
                        kind = v
                pieces.append(piece.decode())
                scores.append(score)
                kinds.append(kind)
            elif field == 2:
                for f, v in _fields(value):
                    kind_of_model = v if f == 3 else kind_of_model
                    suffix = v if f == 24 else suffix
                    self.fallback = v if f == 35 else self.fallback
            elif field == 3:
                for f, v in _fields(value):
                    blob = v if f == 2 else blob
                    self.prefix = v if f == 3 else self.prefix
                    self.squeeze = v if f == 4 else self.squeeze
                    self.escape = v if f == 5 else self.escape
        if kind_of_model != BPE or suffix or not self.escape or {USER, UNUSED} & set(kinds):
            raise ValueError("only BPE models with escaped white space before words, without user-defined or unused "
                             "pieces, are read")
        self.map = CharacterMap(blob)
        self.pieces, self.kinds = pieces, kinds
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        self.rank = {p: -scores[i] for p, i in self.ids.items()}
        self.unknown = kinds.index(UNKNOWN)
        special = {p: i for i, p in enumerate(pieces) if kinds[i] == CONTROL}
        self.begin, self.end = special.get("<s>"), special.get("</s>")
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if kinds[i] == BYTE}
        self.byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        # Bytes of normalised text that an id stands for; an unknown piece without fallback has its own length.
        self.widths = np.array([1 if k == BYTE else 0 if k == CONTROL else len(p.encode())
                                for p, k in zip(pieces, kinds)], np.int64)
        self.chunks = self._chunk_pattern()
        self.cache: dict[str, bytes] = {}

    def _chunk_pattern(self):
        """Pattern of the chunks no piece reaches across, so that each is merged alone and its ids can be kept.

        A chunk ends before a space sign, between a Latin letter and an ASCII mark, and after a line feed, as far as no
        piece of the vocabulary holds that pair of characters inside it.  None: the text is one chunk.
        """
        def crossed(before: str, after: str) -> bool:
            inner = re.compile(f"[{before}][{after}]")
            return any(inner.search(p) for p in self.ids)

        if crossed(f"^{SPACE}", SPACE):
            return None
        ends = [f"(?={SPACE})", r"\Z"]
        marks = MARKS
        if crossed(LATIN, MARKS):
            marks = ""
        else:
            ends.insert(0, f"(?<=[{LATIN}])(?=[{MARKS}])")
        if not any("\n" in p for p in self.ids):
            ends.insert(0, r"(?<=\n)")
        word = f"{SPACE}*[{LATIN}]+(?=[{marks}{SPACE}]|\\Z)"
        return re.compile(f"{word}|{SPACE}*[^{SPACE}]+?(?:{'|'.join(ends)})|{SPACE}+")

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes (and its end) the place in the source's bytes it comes from.

        Longest prefixes are replaced through the character map, other characters stay; then white space is squeezed,
        escaped and given its dummy prefix as the model says.
        """
        data = text.encode()
        if not self.map.units and not self.squeeze:
            body = text.replace(" ", SPACE)
            place = np.arange(len(data), dtype=np.int64)
            if " " in text:
                place = np.repeat(place, np.where(np.frombuffer(data, np.uint8) == 0x20, 3, 1))
            if self.prefix and data:
                body, place = SPACE + body, np.concatenate([np.zeros(3, np.int64), place])
            return body, np.append(place, len(data))
        parts: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at) if self.map.units else None
            if hit:
                parts.append((hit[1], at))
                at += hit[0]
            else:
                n = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                parts.append((data[at:at + n], at))
                at += n
        lead, tail = 0, len(parts)
        if self.squeeze:
            while lead < tail and parts[lead][0] in (b" ", b""):
                lead += 1
        out, place, was_space = [], [], bool(self.squeeze)
        sign = SPACE.encode()
        if lead < tail and self.prefix:
            out.append(sign)
            place += [parts[lead][1]] * 3
        for piece, start in parts[lead:tail]:
            if self.squeeze and was_space:
                piece = piece.lstrip(b" ")
            if piece:
                was_space = piece.endswith(b" ")
                piece = piece.replace(b" ", sign)
                out.append(piece)
                place += [start] * len(piece)
        joined = b"".join(out)
        end = len(data)
        if self.squeeze:
            while joined.endswith(sign):
                joined = joined[:-3]
                end = place[len(joined)]
        return joined.decode(), np.array(place[:len(joined)] + [end], np.int64)

    def _merge(self, chunk: str) -> list[int]:
        parts = list(chunk)
        if len(parts) <= 48:
            rank, none = self.rank.get, math.inf
            ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                parts[i] += parts.pop(i + 1)
                ranks.pop(i)
                if i:
                    ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
                if i < len(ranks):
                    ranks[i] = rank(parts[i] + parts[i + 1], none)
        else:
            parts = self._merge_long(parts)
        out = []
        for p in parts:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out.extend(self.byte_ids[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges with a heap of pairs: a text without white space may be one very long chunk."""
        rank, n = self.rank, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1)
                if (r := rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != whole:
                continue
            parts[i], parts[j], after[i] = whole, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := rank.get(parts[a] + parts[after[a]])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[after[a]]))
        return [p for p in parts if p is not None]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, places): ids without begin and end; ``places[i]:places[i + 1]`` are the source bytes of id ``i``."""
        body, place = self.normalise(text)
        cache = self.cache
        chunks = self.chunks.findall(body) if self.chunks else [body] if body else []
        try:
            found = [cache[c] for c in chunks]
        except KeyError:
            if len(cache) > CHUNK_CACHE:
                cache.clear()
            found = []
            for c in chunks:
                ids = cache.get(c)
                if ids is None:
                    ids = np.array(self._merge(c), "<u4").tobytes()
                    if len(c) <= 64:
                        cache[c] = ids
                found.append(ids)
        ids = np.frombuffer(b"".join(found), "<u4")
        if self.fallback:
            ends = np.cumsum(self.widths[ids])
        else:  # unknown characters: their widths come from the text itself
            ends, at, data = [], 0, body.encode()
            for i in ids.tolist():
                if i == self.unknown:
                    at += 1
                    while at < len(data) and data[at] & 0xC0 == 0x80:
                        at += 1
                else:
                    at += int(self.widths[i])
                ends.append(at)
            ends = np.array(ends, np.int64)
        starts = np.concatenate([[0], ends]).astype(np.int64)
        return ids, place[starts]

    def decode(self, ids) -> str:
        """Text of ids: control pieces are silent, byte runs are read as UTF-8, the dummy prefix goes."""
        out: list[str] = []
        raw = b""
        pieces, byte_of, kinds = self.pieces, self.byte_of, self.kinds
        for i in ids:
            if i in byte_of:
                raw += byte_of[i]
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = b""
            if kinds[i] == NORMAL:
                out.append(pieces[i])
            elif kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text
