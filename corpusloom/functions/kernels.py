"""NumPy kernels over Arrow string buffers, shared by several operators.

All kernels see texts as one byte buffer plus row offsets, so a batch of
documents is handled by a few array operations, without a Python object per
word.  ``pieces`` bounds the bytes handled at once; a single text longer than
the bound is handled alone and whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown on demand and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        step = 1
        while step < size:
            have[step : 2 * step] = have[:step] * U(pow(base, step, 1 << 64))
            step *= 2
        _powers[base] = have
    return have[:n]


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays([c.cast(pa.large_binary()) for c in col.chunks]) if col.num_chunks else pa.array([], pa.large_binary())
    if not (pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.cast(pa.large_binary()).fill_null(b"")
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(data: np.ndarray, off: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and their rows' offsets."""
    if not (data & 0x80).any():
        return data.astype(np.uint32), off
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32), begins[off]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the rows of a piece: byte spans, and for each row the first word's index."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        inside = ~SPACE[data]
        head, last = inside.copy(), inside.copy()
        head[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begins = off[:-1][off[:-1] < off[1:]]
        head[begins] = inside[begins]
        ends = off[1:][off[:-1] < off[1:]] - 1
        last[ends] = inside[ends]
        self.inside = inside
        self.start = np.flatnonzero(head)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.start, off)
        self.count = np.diff(self.row)

    def __len__(self) -> int:
        return len(self.start)

    def of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, fold: bool = False, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit polynomial hashes of the words, or of the spans given; fold: A-Z as a-z."""
        return span_hashes(LOWER[self.data] if fold else self.data, self.start if start is None else start, self.end if end is None else end)

    def joined(self, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes in which words follow one another after one space, and the words' new starts and ends."""
        keep = self.inside.copy()
        keep[1:] |= self.inside[:-1]
        at = np.cumsum(keep) - 1
        out = (LOWER[self.data] if fold else self.data).copy()
        out[~self.inside] = 0x20
        return out[keep], at[self.start], at[self.end - 1] + 1

    def bare(self) -> tuple[np.ndarray, np.ndarray]:
        """Word spans without ASCII punctuation at either end (whole where nothing else is in the word)."""
        solid = ~PUNCT[self.data]
        n = len(self.data)
        nxt = np.where(solid, np.arange(n), n)
        nxt = np.minimum.accumulate(nxt[::-1])[::-1] if n else nxt
        prv = np.maximum.accumulate(np.where(solid, np.arange(n), -1)) if n else nxt
        s, e = nxt[self.start], prv[self.end - 1] + 1
        none = (s >= self.end) | (e <= self.start)
        return np.where(none, self.start, s), np.where(none, self.end, e)


PUNCT = np.zeros(256, bool)
PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, n), out=total[1:])
    return mix((total[end] - total[start]) * powers(_UNBASE, n + 1)[start] + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of every window of k values inside a row, and each window's first index."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(_BASE, n), out=total[1:])
    stop = np.repeat(row[1:], np.diff(row))
    at = np.flatnonzero(np.arange(k, n + k) <= stop)
    return mix((total[at + k] - total[at]) * powers(_UNBASE, n + 1)[at] + U(k)), at


def covered(at: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of k that begins at one of ``at``."""
    edge = np.zeros(n + 1, np.int64)
    edge[:n] += np.bincount(at, minlength=n)[:n]
    stops = np.bincount(at + k, minlength=n + 1)[: n + 1]
    return np.cumsum(edge - stops)[:n] > 0


def ragged(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start:start+length] of every span, one after the other."""
    total = int(length.sum())
    if not total:
        return values[:0]
    first = np.cumsum(length) - length
    return values[np.arange(total) + np.repeat(start - first, length)]


def row_sums(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sums of values[row[i]:row[i+1]]."""
    if values.dtype == bool:
        return np.diff(np.searchsorted(np.flatnonzero(values), row))
    total = np.concatenate([[0], np.cumsum(values)])
    return total[row[1:]] - total[row[:-1]]


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


#: The five primes of the published XXH64 function.
P1, P2, P3, P4, P5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte spans at once."""
    buf = np.concatenate([data, np.zeros(8, np.uint8)])
    lane = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    half = np.ndarray((len(buf) - 3,), "<u4", buf, 0, (1,))
    length = length.astype(np.int64)
    acc = np.full(len(start), seed, np.uint64) + P5
    stripes = length >> 5
    if (big := np.flatnonzero(stripes)).size:
        big = big[np.argsort(-stripes[big], kind="stable")]
        n, p = stripes[big], start[big]
        s = U(seed)
        with np.errstate(over="ignore"):
            v = [np.full(len(big), x, np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
        for k in range(int(n[0])):
            m = int(np.searchsorted(-n, -k, "left"))  # those with more than k stripes come first
            for j in range(4):
                v[j][:m] = _rot(v[j][:m] + lane[p[:m] + (32 * k + 8 * j)] * P2, 31) * P1
        a = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
        for x in v:
            a = (a ^ (_rot(x * P2, 31) * P1)) * P1 + P4
        acc[big] = a
    acc += length.astype(np.uint64)
    p, rest = start + (length & ~31), length & 31
    for k in range(3):
        on = np.flatnonzero(rest >= 8 * (k + 1))
        acc[on] = _rot(acc[on] ^ (_rot(lane[p[on] + 8 * k] * P2, 31) * P1), 27) * P1 + P4
    p, rest = p + (rest & ~7), rest & 7
    on = np.flatnonzero(rest >= 4)
    acc[on] = _rot(acc[on] ^ (half[p[on]].astype(np.uint64) * P1), 23) * P2 + P3
    p, rest = p + (rest & 4), rest & 3
    for k in range(3):
        on = np.flatnonzero(rest > k)
        acc[on] = _rot(acc[on] ^ (buf[p[on] + k].astype(np.uint64) * P5), 11) * P1
    acc ^= acc >> U(33)
    acc *= P2
    acc ^= acc >> U(29)
    acc *= P3
    return acc ^ (acc >> U(32))
