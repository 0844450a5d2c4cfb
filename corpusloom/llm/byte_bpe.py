"""Byte-level BPE with a hierarchical-bitmap rank queue (operator 7).

Merging takes the pair of lowest rank, leftmost first.  Candidate pairs wait in
one bucket of linked-list positions per rank; a bitmap of three levels over the
ranks gives the next non-empty bucket by find-first-set, in constant time;
pairs that an earlier merge has changed are recognised as stale when they come
up, and skipped.  A pre-token of n bytes costs about n steps however long it is.

One queue serves all new pre-tokens of a piece of text at once: they stand one
after the other in the linked list, with walls between them.  As they don't
touch, going by rank over all of them is going by rank in each.  Pre-tokens
seen before come from a bounded table by their 64-bit hash, verified by length
and by the eight bytes at either end.

A null text is empty; an empty text has no ids.  Ids of rows play no part, so
null and repeated ones change nothing; an empty table gives no rows, and only
the column given is read, so other columns' names don't matter.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K

TABLE_SIZE = 800_000  # pre-tokens, about 50 bytes each; a full table starts anew
PIECE = 1 << 20  # bytes handled at once; a longer text is handled alone
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value: the pattern that Splitter knows
LETTER, NUMBER, BLANK, OTHER = range(4)


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in blob.splitlines() if line)}


class RankQueue:
    """Buckets of positions, smallest rank first."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = [0] * ((ranks >> 18) + 1)
        self.bucket: dict[int, list[int]] = {}

    def push(self, rank: int, at: int) -> None:
        have = self.bucket.get(rank)
        if have is None:
            self.put(rank, [at])
        else:
            have.append(at)

    def put(self, rank: int, places: list[int]) -> None:
        """Fill an empty bucket."""
        self.bucket[rank] = places
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top[rank >> 18] |= 1 << (rank >> 12 & 63)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank that has a bucket, and its positions from left to right."""
        for t, word in enumerate(self.top):
            if word:
                break
        else:
            return None
        m = t << 6 | (word & -word).bit_length() - 1
        word = self.mid[m]
        w = m << 6 | (word & -word).bit_length() - 1
        word = self.low[w]
        bit = word & -word
        self.low[w] = word ^ bit
        if word == bit:
            self.mid[m] &= ~(1 << (w & 63))
            if not self.mid[m]:
                self.top[t] &= ~(1 << (m & 63))
        rank = w << 6 | bit.bit_length() - 1
        places = self.bucket.pop(rank)
        places.sort()
        return rank, places


def _classes() -> np.ndarray:
    """Class of every code point, by the regex library's own properties."""
    kind = np.full(0x110000, OTHER, np.uint8)
    for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):
            for m in regex.finditer(pattern, "".join(map(chr, range(lo, hi)))):
                kind[lo + m.start() : lo + m.end()] = value
    return kind


class Splitter:
    """Byte spans of the matches of PLAIN in the rows of a piece, by array operations; other patterns go through regex."""

    def __init__(self, pattern: str):
        self.find = None if pattern == PLAIN else regex.compile(pattern).finditer
        self.kind = _classes() if self.find is None else None

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte of each match, end, row pointers)."""
        if self.find is not None:
            return self._matches(data, off)
        cp = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
        n = len(cp)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        width = 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
        width[(cp >= 0xDC80) & (cp <= 0xDCFF)] = 1
        byte = np.concatenate([[0], np.cumsum(width)])
        text = np.searchsorted(byte, off)
        edge = np.zeros(n + 4, bool)
        edge[text] = True
        kind = self.kind[cp]
        start = np.zeros(n + 4, bool)
        start[0] = True
        start[1:n] = kind[1:] != kind[:-1]
        start[:n] |= edge[:n]
        run = np.flatnonzero(start[:n])
        end = np.append(run[1:], n)
        # white space before a word leaves its last character, which a space gives to the word
        blank = (kind[run] == BLANK) & ~edge[end]
        last = end[blank] - 1
        start[last] = True
        start[end[blank][cp[last] == 0x20]] = False
        # contractions, where a match begins at the apostrophe
        tick = run[(kind[run] == OTHER) & (end - run == 1) & ~edge[end]]
        tick = tick[(cp[tick] == 0x27) & start[tick]]
        if tick.size:
            wide = np.concatenate([cp, np.zeros(3, np.uint32)])
            a, b = wide[tick + 1], np.where(edge[tick + 2], 0, wide[tick + 2])
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
            start[tick[one | two] + 1] = False
            start[tick[one] + 2] = True
            start[tick[two] + 3] = True
        first = np.flatnonzero(start[:n])
        return byte[first], byte[np.append(first[1:], n)], np.searchsorted(first, text)

    def _matches(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spans, row = [], [0]
        for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            text = data[lo:hi].tobytes().decode()
            at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]).astype(np.int64) + lo
            spans += [(at[m.start()], at[m.end()]) for m in self.find(text)]
            row.append(len(spans))
        both = np.array(spans, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1], np.array(row)


def _ends(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number from the length and the first and last eight bytes of spans, which are all of a short one's bytes."""
    buf = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    lane = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    unused = K.U(8) * (K.U(8) - np.minimum(end - start, 8).astype(np.uint64))
    head, tail = lane[start + 8] << unused, lane[end] >> unused
    return K.mix(head ^ (end - start).astype(np.uint64)) + tail


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, Splitter(pattern)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.double = np.full(65536, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
        self.queue = RankQueue(size)
        self._fresh()

    def _fresh(self) -> None:
        """A table with the vocabulary's own tokens: a pre-token that is one needs no merges."""
        h = K.span_hashes(self.bytes, self.first, self.first + self.length)
        on = np.flatnonzero(self.length)
        by = on[np.argsort(h[on])]
        self.known, self.at, self.size = h[by], np.arange(len(by)), np.ones(len(by), np.int64)
        self.ends = _ends(self.bytes, self.first[by], self.first[by] + self.length[by])
        self.ids = by.astype(np.int32)

    def merge(self, raw: bytes, walls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that stand one after the other, and how many each has; walls: where each begins, and the end."""
        n = len(raw)
        data = np.frombuffer(raw, np.uint8).astype(np.int32)
        wall = np.zeros(n + 1, np.uint8)
        wall[walls] = 1
        duo = np.full(n, -1, np.int32)
        if n > 1:
            duo[:-1] = np.where(wall[1:n] == 1, -1, self.double[data[:-1] << 8 | data[1:]])
        by = np.argsort(duo, kind="stable")
        by = by[np.searchsorted(duo[by], 0) :]
        queue, get = self.queue, self.ranks.get
        if by.size:
            heads = np.flatnonzero(np.diff(duo[by], prepend=-1))
            for rank, places in zip(duo[by[heads]].tolist(), np.split(by, heads[1:]), strict=True):
                queue.put(rank, places.tolist())
        pair, ids = duo.tolist(), self.single[data].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        wall, dead = wall.tobytes(), bytearray(n)
        while (got := queue.pop()) is not None:
            rank, places = got
            for k, i in enumerate(places):
                if pair[i] != rank:
                    continue  # stale
                j = after[i]
                end = after[i] = after[j]
                ids[i] = rank
                pair[j] = -1
                dead[j] = 1
                least = rank
                if wall[end]:
                    pair[i] = -1
                else:
                    before[end] = i
                    if (new := get(raw[i : after[end]])) is not None:
                        pair[i] = new
                        queue.push(new, i)
                        least = new
                    else:
                        pair[i] = -1
                if not wall[i]:
                    p = before[i]
                    if (new := get(raw[p:end])) is not None:
                        pair[p] = new
                        queue.push(new, p)
                        if new < least:
                            least = new
                    else:
                        pair[p] = -1
                if least < rank:  # a lower rank has come up: it goes first
                    for p in places[k + 1 :]:
                        queue.push(rank, p)
                    break
        live = np.frombuffer(dead, np.uint8) == 0
        return np.array(ids, np.int32)[live], K.row_sums(live, walls)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a piece, one after the other, and row pointers."""
        start, end, row = self.split(data, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        h, which, back = np.unique(K.span_hashes(data, start, end), return_index=True, return_inverse=True)
        ends = _ends(data, start, end)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        new = np.flatnonzero(self.known[at] != h)
        if new.size:
            if len(self.known) + new.size > TABLE_SIZE:
                self._fresh()
                at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
                new = np.flatnonzero(self.known[at] != h)
            s, size = start[which[new]], end[which[new]] - start[which[new]]
            ids, count = self.merge(K.ragged(data, s, size).tobytes(), np.concatenate([[0], np.cumsum(size)]))
            where = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, ids])
            place = np.searchsorted(self.known, h[new])
            self.known, self.ends, self.at, self.size = (np.insert(a, place, b) for a, b in ((self.known, h[new]), (self.ends, ends[which[new]]), (self.at, where), (self.size, count)))
            at = np.searchsorted(self.known, h)
        size, place, ids = self.size[at][back], self.at[at][back], self.ids
        other = np.flatnonzero(self.ends[at][back] != ends)  # equal hashes of unlike pre-tokens
        if other.size:
            s, length = start[other], end[other] - start[other]
            more, size[other] = self.merge(K.ragged(data, s, length).tobytes(), np.concatenate([[0], np.cumsum(length)]))
            place[other] = len(ids) + np.cumsum(size[other]) - size[other]
            ids = np.concatenate([ids, more])
        return K.ragged(ids, place, size), np.concatenate([[0], np.cumsum(size)])[row]

    def encode_text(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode(raw, np.array([0, len(raw)]))[0]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after the other, and where each id's bytes begin (and the last end)."""
        length = self.length[ids]
        return K.ragged(self.bytes, self.first[ids], length), np.concatenate([[0], np.cumsum(length)])


_codecs: dict[tuple, Codec] = {}


def codec(blob: bytes, pattern: str) -> Codec:
    """One codec, with its table, for each Python worker and vocabulary."""
    key = (hash(blob), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(blob), pattern)
    return _codecs[key]


class ByteBpe:
    """Column functions for one vocabulary, whose file of under MAX_BYTES goes to every executor."""

    MAX_BYTES = 64 << 20

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            blob = f.read(self.MAX_BYTES + 1)
        if len(blob) > self.MAX_BYTES:
            raise ValueError(f"{path} exceeds {self.MAX_BYTES} bytes")
        self.blob, self.pattern = spark.sparkContext.broadcast(blob), pattern

    def encode(self, text: Column) -> Column:
        """Ids of a text, each match of the pattern separately."""
        blob, pattern = self.blob, self.pattern

        @F.arrow_udf("array<int>")
        def bpe_encode(col: pa.Array) -> pa.Array:
            c = codec(blob.value, pattern)
            data, off = K.text_bytes(col)
            ids, rows, seen = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
            for _, _, d, o in K.pieces(data, off, PIECE):
                part, row = c.encode(d, o)
                ids.append(part)
                rows.append(row[1:] + seen)
                seen += len(part)
            return pa.ListArray.from_arrays(pa.array(np.concatenate(rows).astype(np.int32)), pa.array(np.concatenate(ids)))

        return bpe_encode(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of ids; null for null."""
        blob, pattern = self.blob, self.pattern

        @F.arrow_udf("binary")
        def bpe_decode(col: pa.Array) -> pa.Array:
            c = codec(blob.value, pattern)
            counts = pa.compute.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
            row = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            flat = col.flatten().to_numpy(zero_copy_only=False)
            parts, ends = [], [np.zeros(1, np.int64)]
            seen = 0
            for lo in range(0, len(counts), 256):
                data, at = c.decode(flat[row[lo] : row[min(lo + 256, len(counts))]])
                parts.append(data)
                ends.append(at[row[lo + 1 : min(lo + 256, len(counts)) + 1] - row[lo]] + seen)
                seen += len(data)
            data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            out = pa.Array.from_buffers(pa.large_binary(), len(col), [None, pa.py_buffer(np.concatenate(ends).astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())
            return pa.compute.if_else(col.is_null(), pa.scalar(None, pa.binary()), out) if col.null_count else out

        return bpe_decode(ids)
