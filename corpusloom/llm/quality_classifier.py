"""Quality scores from pairwise preferences, Bradley-Terry style (operator 5).

Every pair of a preferred (label 1) and another (label 0) document, of all that
are labelled, trains a linear score by logistic loss on the difference of their
features, which describe form only: shares of capitals, digits, symbols and
punctuation, repetition of words and windows, line shapes.  The loss of a pair
depends on its two scores alone, so a round of Newton's method needs no pairs:
Spark counts the scores of each label in steps of 1 / STEPS and sums up the
features in each step, and from these the driver weighs every row's part in all
its pairs.  The cut is a quantile of all labelled scores: of their quantiles in
steps of a 400th, the one at which the labels are parted best.  Scores are shown
on a logistic scale on which the cut is THRESHOLD.

Null texts count as empty, and empty and very long ones are scored like any
other, whole.  Without labels of both kinds every score is 1.  Ids play no part
in a score, so rows with a null or repeated id are scored row by row; an empty
table gives no rows, and only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.llm import labelled as L
from corpusloom.llm.quality_rules import SYMBOLS, measures
from corpusloom.sources import scratch

#: The weight that all pairs have together, against a ridge of RIDGE.
PAIRS, RIDGE = 40_000, 20.0
#: Steps of a unit of score in which scores are counted: for the weights, and for the cut.
STEPS, FINE = 16, 1024
ROUNDS = 25
#: Labelled ids up to which they go to the texts; beyond that texts are joined by id.
MOST_AT_ONCE = 1_000_000
THRESHOLD = 0.3
SLOPE = 1.0


def form(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Features of form, one row per text, each of about unit size."""
    w = K.Words(data, off)
    m = measures(data, off, w).astype(float)
    n = len(off) - 1
    size = np.diff(off)
    words, lines = np.maximum(m[:, 0], 1), K.row_sums(data == 10, off) + 1.0
    letters = np.maximum(K.row_sums(w.inside & ~K.PUNCT[data], off), 1)
    upper = K.row_sums((data >= 65) & (data <= 90), off) / letters
    digits = K.row_sums((data >= 48) & (data <= 57), off) / letters
    marks = K.row_sums(K.PUNCT[data], off) / words
    loud = K.row_sums(data == 33, off) / words
    signs = K.row_sums(SYMBOLS[data], off) / words
    h = w.hashes(fold=True)
    of = w.of()
    twin = np.zeros(len(h), bool)
    if len(h) > 1:
        twin[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    stutter = np.bincount(of[twin], minlength=n) / words
    key = np.sort((of.astype(np.uint64) << K.U(42)) | (h >> K.U(22)))  # a piece has under 2**22 rows
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    kinds = np.bincount((key[head] >> K.U(42)).astype(np.int64), minlength=n)
    length = w.end - w.start
    mean = np.bincount(of, weights=length, minlength=n) / words
    short = np.bincount(of[length == 1], minlength=n) / words
    huge = np.bincount(of[length > 20], minlength=n) / words
    return np.column_stack([
        np.log1p(m[:, 0]) / 5, m[:, 0] < 20, m[:, 0] < 50, upper, np.sqrt(upper), digits, np.minimum(marks, 4), np.minimum(loud, 2), np.sqrt(np.minimum(signs, 4)), np.minimum(signs, 2),
        m[:, 3] / lines, m[:, 4] / words, np.sqrt(stutter), stutter, kinds / np.sqrt(words) / 10, 1 - kinds / words, np.minimum(mean, 30) / 10, short, huge,
        np.minimum(words / lines, 100) / 50, np.log1p(size) / 8,
    ])


class Model:
    def __init__(self, weights: np.ndarray, center: np.ndarray, scale: np.ndarray, cut: float, spread: float):
        self.weights, self.center, self.scale, self.cut, self.spread = weights, center, scale, cut, spread

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return L.sigmoid(SLOPE * (self.raw(x) - self.cut) / self.spread + np.log(THRESHOLD / (1 - THRESHOLD)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 11) -> Model | None:
    """Bradley-Terry weights from random pairs of rows in memory; train() takes all pairs of a table."""
    good, bad = np.flatnonzero(y > 0), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    center, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - center) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    sign = np.where(np.arange(pairs) % 2 == 0, 1.0, -1.0)  # each way round in turn, so no intercept is learnt
    w = L.logistic(d * sign[:, None], (sign > 0).astype(float), l2=RIDGE, intercept=False)
    s = z @ w
    quantiles = np.quantile(s, np.linspace(0, 1, 401))
    rate = [((s[good] >= q).mean() + (s[bad] < q).mean(), -abs(i - 200)) for i, q in enumerate(quantiles)]
    best = int(np.argmax([r[0] for r in rate]))
    ties = [i for i, r in enumerate(rate) if r[0] >= rate[best][0] - 1e-12]
    cut = float((quantiles[ties[0]] + quantiles[ties[-1]]) / 2)
    return Model(w, center, scale, cut, float(np.std(s) / 4) or 1.0)


def features(docs: DataFrame, labels: DataFrame, label: str, allowed: Column | None = None) -> DataFrame:
    """(label, x) of every labelled row."""
    ids = L.labelled_ids(labels, label, allowed)
    few = ids.limit(MOST_AT_ONCE + 1).count() <= MOST_AT_ONCE
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids) if few else ids, "doc_id")

    @F.arrow_udf("array<double>")
    def formed(col: pa.Array) -> pa.Array:
        parts = [form(d, o) for _, _, d, o in K.pieces(*K.text_bytes(col))]
        x = np.concatenate(parts) if parts else np.zeros((0, 1))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    return rows.select("label", formed(F.col("text")).alias("x"))


def _sums(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> dict[int, float]:
    """Sums by key of what ``part`` makes of (x, labels): keys and values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                k, v = part(x, batch.column("label").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(v.astype(float))], ["k", "v"])

    return {r.k: r.v for r in rows.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}


def _counted(at: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums of the rows of each label at each step: their number, then their columns."""
    key, of = np.unique(at.astype(np.int64) * 2 + y, return_inverse=True)
    sums = np.column_stack([np.bincount(of, w, len(key)) for w in (np.ones(len(x)), *x.T)])
    wide = sums.shape[1]
    return (key[:, None] * wide + np.arange(wide)).ravel(), sums.ravel()


def _by_label(sums: dict[int, float], wide: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For label 0 and label 1: steps in order, and the sums at each."""
    keys = np.array(sorted({k // wide for k in sums}))
    rows = np.array([[sums[int(k) * wide + i] for i in range(wide)] for k in keys])
    return [(keys[keys % 2 == y] // 2, rows[keys % 2 == y]) for y in (0, 1)]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None) -> Model | None:
    """A model of all pairs of labelled rows; None where a label has no row."""
    rows = scratch.written(features(docs, labels, label, allowed), "features")
    moments = _sums(rows, lambda x, y: _counted(np.zeros(len(x)), y, np.column_stack([x, x * x])))
    width = rows.select(F.size("x").alias("n")).limit(1).collect()
    m = width[0].n if width else 0
    (_, bad), (_, good) = _by_label(moments, 2 * m + 1) if moments else [(None, []), (None, [])]
    if not len(bad) or not len(good):
        scratch.drop(rows)
        return None
    n = [bad[0, 0], good[0, 0]]
    mean = (bad + good)[0] / sum(n)
    center = mean[1 : m + 1]
    scale = np.sqrt(np.maximum(mean[m + 1 :] - center**2, 0)) + 1e-6
    each = PAIRS / n[0] / n[1]  # weight of a pair

    def unit(x: np.ndarray) -> np.ndarray:
        return np.clip((x - center) / scale, -8, 8)

    w = np.zeros(m)
    for _ in range(ROUNDS):
        found = _sums(rows, lambda x, y, w=w: _counted(np.floor(unit(x) @ w * STEPS), y, unit(x)))
        (low, bad), (high, good) = _by_label(found, m + 1)
        p = L.sigmoid((low[None, :] - high[:, None]) / STEPS)  # how far a pair is from being right
        v = p * (1 - p)
        g = RIDGE * w - each * ((p @ bad[:, 0]) @ good[:, 1:] - (good[:, 0] @ p) @ bad[:, 1:])
        weight = [dict(zip(low.tolist(), (good[:, 0] @ v).tolist(), strict=True)), dict(zip(high.tolist(), (v @ bad[:, 0]).tolist(), strict=True))]

        def squares(x: np.ndarray, y: np.ndarray, w=w, weight=weight) -> tuple[np.ndarray, np.ndarray]:
            z = unit(x)
            at = np.floor(z @ w * STEPS).astype(np.int64).tolist()
            c = np.array([weight[k].get(a, 0.0) for k, a in zip(y.tolist(), at, strict=True)])
            return np.arange(m * m), ((z * c[:, None]).T @ z).ravel()

        own = _sums(rows, squares)
        cross = good[:, 1:].T @ v @ bad[:, 1:]
        h = each * (np.array([own[i] for i in range(m * m)]).reshape(m, m) - cross - cross.T) + np.diag(np.full(m, RIDGE))
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 2e-3:  # counted scores tell no more
            break
    w = np.round(w, 9)  # sums come in any order
    (low, bad), (high, good) = _by_label(_sums(rows, lambda x, y: _counted(np.floor(unit(x) @ w * FINE), y, np.zeros((len(x), 0)))), 1)
    scratch.drop(rows)
    at = np.union1d(low, high)
    count = np.zeros((2, len(at)))
    count[0, np.searchsorted(at, low)], count[1, np.searchsorted(at, high)] = bad[:, 0], good[:, 0]
    before = np.concatenate([np.zeros((2, 1)), np.cumsum(count, axis=1)], axis=1)
    whole = before.sum(0)
    quantile = np.minimum(np.searchsorted(whole[1:], np.linspace(0, 1, 401) * whole[-1]), len(at) - 1)
    rate = 1 - before[1, quantile] / n[1] + before[0, quantile] / n[0]
    ties = np.flatnonzero(rate >= rate.max() - 1e-12)
    cut = float(at[quantile[ties[0]]] + at[quantile[ties[-1]]]) / 2 / FINE
    s = (at + 0.5) / FINE
    size = count.sum(0)
    spread = float(np.sqrt(max(np.average(s * s, weights=size) - np.average(s, weights=size) ** 2, 0)) / 4)
    return Model(w, center, scale, cut, spread or 1.0)


def score(text: Column, model: Model | None) -> Column:
    """Score of a whole text in [0, 1]."""

    @F.arrow_udf("double")
    def preference(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        if model is None:
            return pa.array(np.ones(len(col)))
        return pa.array(np.concatenate([np.zeros(0), *(model.score(form(d, o)) for _, _, d, o in K.pieces(data, off))]))

    return preference.asNondeterministic()(text)
