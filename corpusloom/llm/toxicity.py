"""Toxicity by exact TF-IDF cosine to labelled examples (operator 3).

A bounded sample of labelled rows gives the examples, and every term of theirs
is in the vocabulary.  A term weighs (1 + log tf) * idf * relevance: idf comes
from document counts over the whole corpus, and relevance is FLOOR plus the G
statistic of the term's presence and the label in the sample, as a multiple of
2 log m, what the best of m terms reaches by chance.  So terms tied to the
label lead, and a text whose words say nothing of the label still finds its
own copy.

The inverted index keeps, for each term and block of examples, the largest
weight; a query adds these up to a bound for each block and visits blocks by
falling bound until no bound exceeds its K-th best cosine, so the cosines are
exact.  Examples stand in the order of their heaviest terms, which keeps most
blocks' bounds low.  The K nearest vote with weight by distance; votes become
calibrated scores by Platt scaling over the sample's own rows, each without
itself.

Terms are words without ASCII punctuation at their ends, A-Z as a-z.  A text
without known terms (null and empty ones too) has no neighbours: its vote is
the share of label 1 among examples that have none either.  Without labels of
both kinds every score is the share of label 1, or 0.  Equal cosines go to the
example that stands first in the index.  Ids play no part in a score: rows with
a null or repeated id are scored like any other.  Clashing column names don't
matter, as only the columns asked for are read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.llm import labelled as L

PER_CLASS = 2000
BLOCK = 64
NEAREST = 8
FLOOR = 0.05
THRESHOLD = 0.7
COMMON = 24
CELLS, QUERIES = 400_000, 400  # (query, term, block) triples, and queries, handled at once


def word_terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    w = K.Words(data, off)
    return w.hashes(True, *w.bare()), w.of()


class Terms:
    """A sorted vocabulary of term hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.gate = np.zeros(1 << 20, bool)
        self.gate[(hashes >> K.U(44)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self, h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, occurrences) of the known words, by row and term."""
        on = np.flatnonzero(self.gate[(h >> K.U(44)).astype(np.int64)])
        h, of = h[on], of[on]
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self) - 1, 0))
        ok = self.hashes[at] == h if len(self) else np.zeros(0, bool)
        key, tf = np.unique(of[ok].astype(np.int64) << 32 | at[ok], return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, tf


def _entropy(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a > 0, a * np.log(a / n), 0) + np.where(b > 0, b * np.log(b / n), 0)


def relevance(row: np.ndarray, term: np.ndarray, y: np.ndarray, m: int) -> np.ndarray:
    """FLOOR and the G statistic of each of m terms' presence and the label, over 2 log m."""
    label = y[row]
    a = np.bincount(term, weights=label, minlength=m)
    b = np.bincount(term, weights=1 - label, minlength=m)
    pos, neg = y.sum(), len(y) - y.sum()
    g = 2 * (_entropy(a, b) + _entropy(pos - a, neg - b) - _entropy(np.full(m, pos), np.full(m, neg)))
    return FLOOR + np.maximum(g, 0) / (2 * np.log(max(m, 2)))


def unit(row: np.ndarray, term: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of unit vectors."""
    weight = (1 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=n))
    return row, term, weight / norm[row]


def _edges(sorted_values: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_values, np.arange(n + 1))


class Index:
    """Examples by term and block of BLOCK examples, with each such cell's largest weight.

    The lists of terms that are in at least one of COMMON examples are as good
    as full, and are kept by block as matrices; those of other terms are sparse.
    """

    def __init__(self, terms: Terms, idf: np.ndarray, row: np.ndarray, term: np.ndarray, weight: np.ndarray, y: np.ndarray):
        self.terms, self.idf, self.n, self.y = terms, idf, len(y), y.astype(float)
        self.blocks = -(-max(len(y), 1) // BLOCK)
        by = np.lexsort((row, term))
        row, term, weight = row[by], term[by], weight[by]
        full = np.flatnonzero(np.bincount(term, minlength=len(terms)) * COMMON >= max(len(y), 1))
        self.column = np.full(len(terms), -1, np.int32)
        self.column[full] = np.arange(len(full))
        on = self.column[term] >= 0
        self.lists = np.zeros((len(full), self.blocks * BLOCK))
        self.lists[self.column[term[on]], row[on]] = weight[on]
        self.peaks = self.lists.reshape(len(full), self.blocks, BLOCK).max(axis=2, initial=0)
        row, term, weight = row[~on], term[~on], weight[~on]
        self.example, self.weight = row.astype(np.int32), weight
        cell, first = np.unique(term * self.blocks + row // BLOCK, return_index=True)
        self.posting = np.append(first, len(row)).astype(np.int32)  # a cell's postings
        self.cell = _edges(cell // self.blocks, len(terms)).astype(np.int32)  # a term's cells
        self.block = (cell % self.blocks).astype(np.int32)
        self.most = np.maximum.reduceat(weight, first) if len(first) else np.zeros(0)
        self.bare_share, self.slope, self.bias = 0.0, 1.0, 0.0

    def vectors(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) of unit TF-IDF vectors, by row."""
        return unit(*self.terms.counts(*word_terms(data, off)), self.idf, len(off) - 1)

    def nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int = NEAREST, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each of n queries the k examples of largest positive cosine, exactly, and the cosines (-1 and 0 where there are fewer)."""
        found, cosine = np.full((n, k), -1), np.zeros((n, k))
        edge = _edges(row, n)
        size = np.append(0, np.cumsum(self.cell[term + 1] - self.cell[term]))[edge] + np.arange(n + 1) * (CELLS // QUERIES)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(size, size[lo] + CELLS, "right")) - 1)
            on = slice(edge[lo], edge[hi])
            found[lo:hi], cosine[lo:hi] = self._search(row[on] - lo, term[on], weight[on], hi - lo, k, None if without is None else without[lo:hi])
            lo = hi
        return found, cosine

    def _search(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, without: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        width = self.blocks * BLOCK
        common = self.column[term]
        dense = np.zeros((n, len(self.lists)))
        dense[row[common >= 0], common[common >= 0]] = weight[common >= 0]
        row, term, weight = row[common < 0], term[common < 0], weight[common < 0]
        length = self.cell[term + 1] - self.cell[term]
        cell = K.ragged(np.arange(len(self.block), dtype=np.int32), self.cell[term], length)
        query, w = np.repeat(row, length), np.repeat(weight, length)
        place = query * self.blocks + self.block[cell]
        bound = dense @ self.peaks + np.bincount(place, weights=w * self.most[cell], minlength=n * self.blocks).reshape(n, self.blocks)
        rank = np.argsort(np.argsort(-bound, axis=1, kind="stable"), axis=1, kind="stable")
        total, floor = np.zeros((n, width)), np.zeros(n)
        done, step = 0, 4
        while done < self.blocks:
            visit = (rank >= done) & (rank < done + step) & (bound > 0) & (bound >= floor[:, None] - 1e-12)
            done, step = done + step, 4 * step
            go = np.flatnonzero(visit.any(axis=1))
            if not len(go):
                break
            for b in np.flatnonzero(visit.any(axis=0)):
                q = np.flatnonzero(visit[:, b])
                total[q, b * BLOCK : (b + 1) * BLOCK] = dense[q] @ self.lists[:, b * BLOCK : (b + 1) * BLOCK]
            on = np.flatnonzero(visit.ravel()[place])
            c = cell[on]
            many = self.posting[c + 1] - self.posting[c]
            at = K.ragged(np.arange(len(self.example), dtype=np.int32), self.posting[c], many)
            total += np.bincount(np.repeat(query[on] * width, many) + self.example[at], weights=np.repeat(w[on], many) * self.weight[at], minlength=n * width).reshape(n, width)
            if without is not None:
                total[np.arange(n), without] = 0
            if k < width:
                floor[go] = -np.partition(-total[go], k - 1, axis=1)[:, k - 1]
        found, cosine = np.full((n, k), -1), np.zeros((n, k))
        q, e = np.nonzero((total > 0) & (total >= floor[:, None] - 1e-12))
        score = np.round(total[q, e], 12)
        by = np.lexsort((e, -score, q))
        q, e, score = q[by], e[by], score[by]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        top = nth < k
        found[q[top], nth[top]], cosine[q[top], nth[top]] = e[top], score[top]
        return found, cosine

    def votes(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each query's share of label 1 among its neighbours, weighted by distance; the neighbours and their cosines."""
        e, s = self.nearest(row, term, weight, n, without=without)
        w = (e >= 0) / (1.05 - np.minimum(s, 1)) ** 2
        total = w.sum(1)
        near = (w * (self.y[e] if len(self.y) else 0.0)).sum(1)
        return np.where(total > 0, near / np.where(total > 0, total, 1), self.bare_share), e, s

    def score(self, vote: np.ndarray) -> np.ndarray:
        return L.sigmoid(self.slope * vote + self.bias)


def example_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word."""
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    hs, ofs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, _, d, o in K.pieces(np.frombuffer(b"".join(raw), np.uint8), off):
        h, of = word_terms(d, o)
        hs.append(h)
        ofs.append(of + lo)
    return np.concatenate(hs), np.concatenate(ofs)


def document_counts(docs: DataFrame, terms: Terms, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, and the number of texts, over the whole table; what reaches the driver is bounded by the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(terms), np.int64), 0
        for b in batches:
            texts += b.num_rows
            for _, _, d, o in K.pieces(*K.text_bytes(b.column(0))):
                total += np.bincount(terms.counts(*word_terms(d, o))[1], minlength=len(terms))
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(on, -1).astype(np.int32)), pa.array(np.append(total[on], texts))], ["term", "n"])

    got = docs.select(text_col).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = got["term"].to_numpy(), got["n"].to_numpy()
    out = np.zeros(len(terms), np.int64)
    out[term[term >= 0]] = n[term >= 0]
    return out, int(n[term < 0].sum())


def build(texts: list[str], y: np.ndarray, docs: DataFrame | None = None, text_col: str = "text") -> tuple[Index, np.ndarray]:
    """An index of the texts with their labels, and which text each example is; equal texts should come once.

    Document counts are those of docs, or else of the texts themselves.
    """
    h, of = example_words(texts)
    terms = Terms(np.unique(h))
    row, term, tf = terms.counts(h, of)
    df, total = document_counts(docs, terms, text_col) if docs is not None and len(terms) else (np.bincount(term, minlength=len(terms)), len(y))
    idf = np.log((1 + total) / (1 + np.minimum(df, total))) + 1
    both = 0 < y.sum() < len(y)
    if both:
        idf = idf * relevance(row, term, y, len(terms))
    row, term, weight = unit(row, term, tf, idf, len(y))
    lead = np.full(len(y), -1)
    by = np.lexsort((weight, row))
    last = np.flatnonzero(np.append(row[by][1:] != row[by][:-1], True)) if len(row) else by
    lead[row[by][last]] = term[by][last]
    order = np.argsort(lead, kind="stable")
    place = np.empty(len(y), np.int64)
    place[order] = np.arange(len(y))
    row, y = place[row], y[order]
    index = Index(terms, idf, row, term, weight, y)
    if not both:
        share = float(y.mean()) if len(y) else 0.0
        index.bare_share, index.slope, index.bias = share, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return index, order
    bare = np.ones(len(y), bool)
    bare[row] = False
    index.bare_share = float((y[bare].sum() + 0.1) / (bare.sum() + 1))
    by = np.argsort(row, kind="stable")
    votes, _, _ = index.votes(row[by], term[by], weight[by], len(y), np.arange(len(y)))
    index.slope, index.bias = L.calibrate(votes, y)
    return index, order


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, allowed: Column | None = None) -> tuple[Index, list]:
    """The index over at most ``per_class`` labelled rows of each kind, and the examples' ids."""
    rows = list({(r.text, r.label): r for r in L.sample(docs, labels, label, per_class, allowed).collect()}.values())
    index, order = build([r.text for r in rows], np.array([r.label for r in rows], float), docs)
    return index, [rows[i].doc_id for i in order]


def judge(text: Column, index: Index, ids: list | None = None) -> Column:
    """Struct of the score and its evidence: ids and cosines of the nearest examples."""
    names = np.array(ids if ids is not None else range(index.n), np.int64)

    @F.arrow_udf("struct<score:double,evidence:array<bigint>,cosine:array<double>>")
    def toxicity(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        votes, examples, cosines, counts = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(1, np.int64)]
        for _, _, d, o in K.pieces(data, off):
            v, e, s = index.votes(*index.vectors(d, o), len(o) - 1)
            votes.append(v)
            examples.append(e[e >= 0])
            cosines.append(s[e >= 0])
            counts.append((e >= 0).sum(1))
        at = pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32))
        e = np.concatenate(examples)
        lists = [pa.ListArray.from_arrays(at, pa.array(c)) for c in (names[e] if len(e) else e, np.concatenate(cosines))]
        return pa.StructArray.from_arrays([pa.array(index.score(np.concatenate(votes))), *lists], ["score", "evidence", "cosine"])

    return toxicity.asNondeterministic()(text)
