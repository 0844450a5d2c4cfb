"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 8).

An item of n words leaks into a text that has a passage within
floor((1 - similarity) * n) word edits of it.  Words are compared without
ASCII punctuation at their ends, A-Z as a-z.  Items so short that no edit is
allowed (under five words) match exactly.

Windows of the item's size are embedded by CGK random walks, which turn edit
distance into Hamming distance; tables of a few sampled coordinates of several
walks give candidates, and the exact edit distance around each candidate
decides.  The number of walks is not fixed: for each size it is the least of
WALKS at which planted leaks with exactly the allowed number of deletions (one
by one or in one block), insertions or substitutions are proposed at the rate
``recall`` or more; this is tried out when the items are loaded.  An item of
more than SEGMENT words is looked for by segments: of a leak within 0.2 n edits
one segment at least is within 0.2 of its own length.

Windows that cannot match are passed over first, without loss: of d + 1
disjoint pieces of a segment, d edits leave one whole, so a match begins near
a place where a piece occurs.

The items go to the executors in blocks of at most BLOCK_WORDS words, with one
pass over the texts for each block, so a worker holds one block.  Null and
empty texts leak nothing; items without words match nothing; repeated items
are each reported.  Each row of the texts is judged by its own text: a null id
is reported as null, and rows that share an id are reported one by one.  Empty
tables give no rows, and only the columns asked for are read, so other columns'
names don't matter.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.sources import scratch

SIMILARITY = 0.8
RECALL = 0.95
SEGMENT = 65
WALKS, TABLES, SAMPLED = (4, 8, 16, 32, 64), 8, 2
SIZES = (5, 10, 15, 20, 25, 30, 40, 50, 65)  # sizes tried out; others take the walks of the next larger one
TRIALS = 40
BLOCK_WORDS = 2_000_000
LEAK = "struct<item_id:bigint,start:int,end:int,distance:int>"
LEAKS = f"array<{LEAK}>"


def normal_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bare, folded words and row pointers."""
    w = K.Words(data, off)
    return w.hashes(True, *w.bare()), w.row


def embed(h: np.ndarray, first: np.ndarray, stop: np.ndarray, size: np.ndarray, walk: np.ndarray, seed: int) -> np.ndarray:
    """Signatures (TABLES x windows) of random walks over windows of ``size`` words that begin at ``first``; words from ``stop`` on count as none."""
    count = len(first)
    # early coordinates suffer least from edits further on, so tables sample the first two thirds of a walk's 3 n steps
    steps = 2 * int(size.max(initial=0)) + 1
    coins = np.random.default_rng([seed, 1]).integers(1, 1 << 63, (int(walk.max(initial=0)) + 1, steps)).astype(np.uint64)
    chosen = np.random.default_rng([seed, 2]).random((len(coins), TABLES, SAMPLED))
    wanted = (chosen[walk] * (2 * size)[:, None, None]).astype(np.int64)  # windows x TABLES x SAMPLED
    trace = np.zeros((steps, count), np.uint64)
    at = first.copy()
    end = first + size
    inside = np.minimum(end, stop)
    last = len(h) - 1
    for j in range(steps):
        now = np.where(at < inside, h[np.minimum(at, last)], K.U(0))
        trace[j] = now
        at += (at < end) & ((K.mix(now ^ coins[walk, j]) & K.U(1)) > 0)
    rows = np.arange(count)
    sig = np.zeros((TABLES, count), np.uint64)
    for t in range(TABLES):
        for c in range(SAMPLED):
            step = wanted[:, t, c]
            sig[t] = K.mix(sig[t] * K.U(31) + trace[step, rows] + step.astype(np.uint64))
        sig[t] = K.mix(sig[t] ^ K.mix((walk * TABLES + t + 1).astype(np.uint64)) + size.astype(np.uint64))
    return sig


def _rows(items: np.ndarray, spans: np.ndarray, anywhere: bool) -> np.ndarray:
    """For each pair and each place of its span the least edit distance of the item to a passage that ends there, and begins anywhere or with the span."""
    place = np.arange(spans.shape[1] + 1, dtype=np.int32)
    row = np.broadcast_to(np.zeros_like(place) if anywhere else place, (len(items), len(place)))
    for i in range(items.shape[1]):
        step = np.empty((len(items), len(place)), np.int32)
        step[:, 0] = i + 1
        step[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (spans != items[:, i : i + 1]))
        row = np.minimum.accumulate(step - place, axis=1) + place
    return row


def best_passage(items: np.ndarray, spans: np.ndarray, begin: np.ndarray, end: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, distance, first word, end) of the pairs whose span has, from its word begin to its word end, a passage within d edits of the item: the nearest, that ends first, of a length nearest the item's."""
    place = np.arange(spans.shape[1] + 1)
    row = _rows(items, spans, True)
    row = np.where((place >= begin[:, None]) & (place <= end[:, None]), row, np.int32(1 << 20))
    stop = np.argmin(row, axis=1)
    dist = row[np.arange(len(items)), stop]
    on = np.flatnonzero(dist <= d)
    if not len(on):
        return on, dist[on], stop[on], stop[on]
    # from its end backwards, the passage's length
    n = items.shape[1]
    back = stop[on][:, None] - 1 - np.arange(n + d)
    turned = np.where(back >= begin[on][:, None], np.take_along_axis(spans[on], np.maximum(back, 0), 1), K.U(0))
    length = np.arange(n + d + 1)
    row = _rows(items[on][:, ::-1], turned, False).astype(np.int64)
    row = np.where(length <= (stop[on] - begin[on])[:, None], row, 1 << 40)
    best = np.argmin(row * (4 * (n + d) + 4) + np.abs(length - n), axis=1)
    return on, dist[on], stop[on] - best, stop[on]


class Items:
    """One block of items: their words, and the segments by which they are looked for."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, row: np.ndarray, similarity: float = SIMILARITY, recall: float = RECALL, seed: int = 5, walks: int | None = None):
        self.ids, self.words, self.row, self.seed, self.similarity = ids, words, row, seed, similarity
        self.n = np.diff(row)
        self.edits = self._allowed(self.n)
        parts = -(-self.n // SEGMENT)
        self.item = np.repeat(np.arange(len(self.n)), parts)
        nth = np.arange(len(self.item)) - np.repeat(np.cumsum(parts) - parts, parts)
        n, parts = self.n[self.item], parts[self.item]
        self.shift = nth * n // parts  # of a segment within its item
        self.size = (nth + 1) * n // parts - self.shift
        self.room = self._allowed(self.size)
        self.walks = {int(k): walks or (1 if not self._allowed(k) else walks_needed(int(k), similarity, recall, seed)) for k in np.unique(self.size)}
        self._set_pieces()
        segment, walk = self._walks_of(self.size)
        first = row[self.item[segment]] + self.shift[segment]
        sig = embed(words, first, first + self.size[segment], self.size[segment], walk, seed).ravel() if len(segment) else np.zeros(0, np.uint64)
        by = np.argsort(sig, kind="stable")
        self.signature, self.signed = sig[by], np.tile(segment, TABLES)[by]

    def _allowed(self, n):
        return np.floor((1 - self.similarity) * n + 1e-9).astype(np.int64)

    def _walks_of(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, walk) of each walk over windows of these sizes."""
        sizes = np.array(sorted(self.walks), np.int64)
        many = np.array([self.walks[int(k)] for k in sizes], np.int64)[np.searchsorted(sizes, size)]
        return np.repeat(np.arange(len(size)), many), K.ragged(np.arange(max(many.max(initial=0), 1)), np.zeros(len(many), np.int64), many)

    def _set_pieces(self) -> None:
        piece = self.size // (self.room + 1)
        start = self.row[self.item] + self.shift
        self.pieces = {}
        for q in np.unique(piece).tolist():
            own = np.flatnonzero(piece == q)
            of = np.repeat(own, self.room[own] + 1)
            shift = K.ragged(np.arange(int(self.room.max()) + 1), np.zeros(len(own), np.int64), self.room[own] + 1) * q
            h, at = K.windows(self.words, np.array([0, len(self.words)]), q)
            h = h[start[of] + shift]  # windows of all words stand at their first word
            by = np.argsort(h, kind="stable")
            gate = np.zeros(1 << 20, bool)
            gate[(h >> K.U(44)).astype(np.int64)] = True
            self.pieces[q] = (h[by], of[by], shift[by], gate)

    def starts(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (size, first word) of the windows that a segment can match: they begin at most d words from where a piece occurs."""
        keys = [np.zeros(0, np.int64)]
        for q, (have, of, shift, gate) in self.pieces.items():
            x, at = K.windows(h, row, q)
            on = np.flatnonzero(gate[(x >> K.U(44)).astype(np.int64)])
            x, at = x[on], at[on]
            lo, hi = np.searchsorted(have, x, "left"), np.searchsorted(have, x, "right")
            k = K.ragged(np.arange(len(have)), lo, hi - lo)
            at = np.repeat(at, hi - lo)
            doc = np.searchsorted(row, at, "right") - 1
            # size, text and place, which may be up to SEGMENT words before the text, in one number
            hit = np.unique(self.size[of[k]] << 56 | doc << 34 | (at - shift[k] - row[doc] + SEGMENT))
            size, doc = hit >> 56, hit >> 34 & ((1 << 22) - 1)
            begin, d = (hit & ((1 << 34) - 1)) - SEGMENT + row[doc], self._allowed(size)
            around = np.repeat(begin - d, 2 * d + 1) + K.ragged(np.arange(2 * int(d.max(initial=0)) + 1), np.zeros(len(d), np.int64), 2 * d + 1)
            size, doc = np.repeat(size, 2 * d + 1), np.repeat(doc, 2 * d + 1)
            ok = (around >= row[doc]) & (around < row[doc + 1])
            keys.append(np.unique(size[ok] << 40 | around[ok]))
        key = np.unique(np.concatenate(keys))
        return key >> 40, key & ((1 << 40) - 1)

    def candidates(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (segment, first word) that share a sampled signature."""
        sizes, firsts = self.starts(h, row)
        found = [np.zeros(0, np.int64)]
        step = 40_000 // max(self.walks.values(), default=1)
        for lo in range(0, len(firsts), step):
            size, first = sizes[lo : lo + step], firsts[lo : lo + step]
            stop = row[np.searchsorted(row, first, "right")]
            w, walk = self._walks_of(size)
            sig = embed(h, first[w], stop[w], size[w], walk, self.seed).ravel()
            left, right = np.searchsorted(self.signature, sig, "left"), np.searchsorted(self.signature, sig, "right")
            w = np.tile(w, TABLES)
            segment = self.signed[K.ragged(np.arange(len(self.signed)), left, right - left)]
            w = np.repeat(w, right - left)
            same = self.size[segment] == size[w]
            found.append(np.unique(segment[same] << 40 | first[w[same]]))
        key = np.unique(np.concatenate(found))
        return key >> 40, key & ((1 << 40) - 1)

    def leaks(self, h: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word in it, end, distance) for each leaking pair, its best passage."""
        segment, first = self.candidates(h, row)
        item, doc = self.item[segment], np.searchsorted(row, first, "right") - 1
        slack = self.edits[item] + 2 * self.room[segment]  # between where the window begins and where the leak would
        begin = first - self.shift[segment] - slack
        best: dict[tuple[int, int], tuple] = {}
        for n in np.unique(self.n[item]).tolist():
            own = np.flatnonzero(self.n[item] == n)
            d = int(self.edits[item[own[0]]])
            width = int(n + d + 2 * slack[own].max())
            pairs = np.unique(np.stack([doc[own], item[own], begin[own]]), axis=1)
            step = max(1, min(4000, 2_000_000 // width))
            for lo in range(0, pairs.shape[1], step):
                k, i, b = pairs[:, lo : lo + step]
                at = b[:, None] + np.arange(width)
                spans = np.where((at >= row[k][:, None]) & (at < row[k + 1][:, None]), h[np.clip(at, 0, len(h) - 1)], K.U(0))
                low, high = np.maximum(row[k] - b, 0), np.minimum(row[k + 1] - b, width)
                on, dist, start, end = best_passage(self.words[self.row[i][:, None] + np.arange(n)], spans, low, high, d)
                base = b[on] - row[k[on]]
                for key_doc, key_item, x, s, e in zip(k[on].tolist(), i[on].tolist(), dist.tolist(), (base + start).tolist(), (base + end).tolist(), strict=True):
                    best[key_doc, key_item] = min(best.get((key_doc, key_item), (1 << 30,)), (x, s, e))
        return sorted((k, int(self.ids[i]), s, e, x) for (k, i), (x, s, e) in best.items())


def planted(n: int, d: int, trials: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items of n words and texts with leaks of exactly d edits: (item words, texts' words, texts' rows, kind of edit); a text for each item."""
    rng = np.random.default_rng([seed, n, d])
    kinds = np.arange(4 * trials) % 4
    items = rng.integers(1, 1 << 62, (len(kinds), n)).astype(np.uint64)
    texts = []
    for kind, item in zip(kinds, items, strict=True):
        at = rng.choice(n, d, replace=False)
        new = rng.integers(1, 1 << 62, d).astype(np.uint64)
        leak = item.copy()
        if kind == 0:
            leak = np.delete(item, at)
        elif kind == 1:
            k = int(rng.integers(0, n - d + 1))
            leak = np.delete(item, slice(k, k + d))
        elif kind == 2:
            leak = np.insert(item, at, new)
        else:
            leak[at] = new
        around = rng.integers(1, 1 << 62, (2, n)).astype(np.uint64)
        texts.append(np.concatenate([around[0], leak, around[1]]))
    return items, np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), kinds


_needed: dict[tuple, int] = {}


def walks_needed(n: int, similarity: float, recall: float, seed: int) -> int:
    """The least of WALKS that proposes planted leaks at the bound at the rate ``recall`` or more, for each kind of edit; an error if none does."""
    n = next((s for s in SIZES if s >= n), n)
    key = (n, similarity, recall, seed)
    if key not in _needed:
        d = int(np.floor((1 - similarity) * n + 1e-9))
        items, h, row, kinds = planted(n, d, TRIALS, seed)
        for walks in WALKS:
            block = Items(np.arange(len(items)), items.ravel(), np.arange(len(items) + 1) * n, similarity, recall, seed, walks)
            segment, first = block.candidates(h, row)
            hit = np.zeros(len(items), bool)
            doc = np.searchsorted(row, first, "right") - 1
            hit[doc[block.item[segment] == doc]] = True
            if min(hit[kinds == k].mean() for k in range(4)) >= recall:
                break
        else:
            raise ValueError(f"{WALKS[-1]} walks find less than {recall} of the leaks of items of {n} words at similarity {similarity}: ask for a lower recall or a higher similarity")
        _needed[key] = walks
    return _needed[key]


def load_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> list[Items]:
    """The benchmark in blocks that fit an executor; the benchmark is a stated query set and is read through the driver once."""
    ids: list = []
    words, counts = [], []
    blocks: list[Items] = []

    def close():
        if ids:
            blocks.append(Items(np.array(ids, np.int64), np.concatenate(words), np.concatenate([[0], np.cumsum(counts)]), similarity, recall))
            ids.clear()
            words.clear()
            counts.clear()

    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).filter("i is not null").orderBy("i", "t")
    for r in rows.toLocalIterator():
        raw = np.frombuffer(r.t.encode(), np.uint8)
        h, _ = normal_words(raw, np.array([0, len(raw)]))
        if ids and sum(counts) + len(h) > block_words:
            close()
        ids.append(r.i)
        words.append(h)
        counts.append(len(h))
    close()
    return blocks


def leaks(text: Column, items: Items) -> Column:
    """Array of (item_id, start, end, distance) in words, by item, of one block; empty for a clean text."""

    @F.arrow_udf(LEAKS)
    def benchmark_leaks(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        count = np.zeros(len(col) + 1, np.int32)
        found: list = []
        for lo, _, d, o in K.pieces(data, off):
            for doc, *leak in items.leaks(*normal_words(d, o)):
                count[lo + doc + 1] += 1
                found.append(leak)
        cols = np.array(found, np.int64).reshape(-1, 4).T
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        names = ["item_id", "start", "end", "distance"]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(count).astype(np.int32)), pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names))

    return benchmark_leaks.asNondeterministic()(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, start, end, distance) for each pair of a text and an item that leaks into it."""
    blocks = load_items(benchmark, **options)
    if not blocks:
        blocks = [Items(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(1, np.int64))]
    passes = [docs.select(F.col(id_col).alias("doc_id"), F.explode(leaks(F.col(text_col), b)).alias("leak")) for b in blocks]
    return reduce(DataFrame.union, passes).select("doc_id", "leak.*")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs into which no item leaks; what one block of items leaves is written before the next."""
    blocks = load_items(benchmark, **options)
    for k, block in enumerate(blocks):
        found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("record"), leaks(docs[text_col], block).alias("leaks"))
        docs = found.filter(F.size("leaks") == 0).select("record.*")
        if k + 1 < len(blocks):
            docs = scratch.written(docs, "clean")
    return docs
