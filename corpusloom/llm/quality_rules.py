"""Quality rules: exact text measures and a hashed n-gram logistic regression (operator 10).

The regression sees hashed word unigrams, word bigrams and character 4-grams
(code points) as square-root frequencies of unit length; it is trained by averaged
stochastic gradient descent on a bounded sample of labelled rows, calibrated
by Platt scaling on rows held out of the training, and scored in Arrow batches
against a fixed threshold.

Null texts count as empty: no words, base_failed.  Rows are judged one by one:
null or repeated ids and repeated rows give a row each, with the same verdict;
very long texts are read whole, alone in their piece.  A score equal to the
threshold keeps.  Labels with a null id, or of both kinds for one id, don't
count; without labels of both kinds the verdict rests on the base rules alone.
An empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.llm import labelled as L

BITS = 16
PER_CLASS = 1500
KEEP_AT = 0.3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measures(data: np.ndarray, off: np.ndarray, w: K.Words | None = None) -> np.ndarray:
    """Rows of (words, code points in words, symbols, repeated lines, words in repeated 3-word windows)."""
    n = len(off) - 1
    w = K.Words(data, off) if w is None else w
    chars = K.row_sums((w.inside & ((data & 0xC0) != 0x80)), off)
    symbols = K.row_sums(SYMBOLS[data], off)
    salt = K.mix(np.arange(1, n + 1, dtype=np.uint64))
    # lines: cut at \n and at both ends of a text
    cut = data == 10
    begin = np.union1d(np.flatnonzero(cut) + 1, off[:-1])
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))[: len(begin)]
    end = end - cut[end - 1] if len(end) else end
    has = np.add.reduceat(w.inside, begin) > 0 if len(begin) else np.zeros(0, bool)
    begin, end = begin[has], end[has]
    of = np.searchsorted(off, begin, "right") - 1
    key = K.span_hashes(data, begin, end) ^ salt[of]
    by = np.argsort(key, kind="stable")
    again = by[1:][key[by][1:] == key[by][:-1]]
    lines = np.bincount(of[again], minlength=n)
    # words in windows of three that come twice or more
    h, at = K.windows(w.hashes(), w.row, 3)
    repeat = np.zeros(n, np.int64)
    if len(h):
        word_of = w.of()
        key = h ^ salt[word_of[at]]
        by = np.argsort(key)
        same = key[by][1:] == key[by][:-1]
        many = np.zeros(len(h), bool)
        many[by[1:][same]] = True
        many[by[:-1][same]] = True
        repeat = np.bincount(word_of[K.covered(at[many], 3, len(w))], minlength=n)
    return np.column_stack([w.count, chars, symbols, lines, repeat]).astype(np.int64)


def slots(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of every n-gram, row after row, and the row offsets."""
    w = K.Words(data, off)
    h = w.hashes()
    two, at2 = K.windows(h, w.row, 2)
    shift = K.U(64 - bits)
    points, begin = K.code_points(data, off)
    points = points.astype(np.uint64)
    at4 = np.flatnonzero(np.arange(4, len(points) + 4) <= np.repeat(begin[1:], np.diff(begin)))
    grams = sum(points[at4 + k] << K.U(16 * k) for k in range(4)) if len(at4) else np.zeros(0, np.uint64)  # those beyond 16 bits run into the next, as any hash may
    four = (K.mix(grams + K.U(3)) >> shift).astype(np.int32)
    of4 = np.searchsorted(begin, at4, "right") - 1
    word_of = w.of()
    slot = np.concatenate([(K.mix(h + K.U(1)) >> shift).astype(np.int32), (K.mix(two + K.U(2)) >> shift).astype(np.int32), four])
    of = np.concatenate([word_of, word_of[at2], of4])
    return slot, of


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, slot) and weights: square roots of counts, rows of unit length."""
    slot, of = slots(data, off, bits)
    key = of.astype(np.int64) << bits | slot
    key.sort()
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(key)))
    row, slot = key[head] >> bits, key[head] & ((1 << bits) - 1)
    weight = np.sqrt(count)
    norm = np.sqrt(np.bincount(row, weights=count, minlength=len(off) - 1))
    return row, slot, weight / norm[row]


class Model:
    """Weights of the slots, and the calibration."""

    def __init__(self, weights: np.ndarray, slope: float, bias: float):
        self.weights, self.slope, self.bias = weights.astype(np.float32), slope, bias

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        row, slot, weight = features(data, off)
        z = np.bincount(row, weights=weight * self.weights[slot], minlength=len(off) - 1)
        return L.sigmoid(self.slope * z + self.bias)


def fit(texts: list[str], y: np.ndarray, rounds: int = 12, step: float = 4.0, seed: int = 7) -> Model | None:
    """Train on four fifths of the rows and calibrate on the rest; None without both labels."""
    if len(set(y.tolist())) < 2:
        return None
    rows = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, s, v = features(raw, np.array([0, len(raw)]))
        rows.append((s, v))
    held = np.arange(len(y)) % 5 == 0
    w, total = np.zeros(1 << BITS), np.zeros(1 << BITS)
    rng = np.random.default_rng(seed)
    train = np.flatnonzero(~held)
    share = y[train].mean()
    for k in range(rounds):
        rate = step / (1 + k)
        for i in rng.permutation(train):
            s, v = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[s] @ v, -30, 30)))
            w[s] -= rate * (p - y[i]) * v * (0.5 / (share if y[i] else 1 - share))
        total += w
    w = total / rounds
    z = np.array([w[s] @ v for s, v in rows])
    cal = held if len(set(y[held].tolist())) == 2 else np.ones(len(y), bool)
    return Model(w, *L.calibrate(z[cal], y[cal]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """Fit on at most ``per_class`` labelled rows of each kind."""
    rows = L.sample(docs, labels, label, per_class).collect()
    return fit([r.text for r in rows], np.array([r.label for r in rows], float)) if rows else None


def judge(text: Column, model: Model | None) -> Column:
    """Struct of the measures and the model's calibrated score (1 without a model)."""

    @F.arrow_udf(f"struct<{MEASURES.replace(' long', ':long')},score:double>")
    def quality_rules(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        m, s = [np.zeros((0, 5), np.int64)], [np.zeros(0)]
        for _, _, d, o in K.pieces(data, off):
            m.append(measures(d, o))
            s.append(model.score(d, o) if model else np.ones(len(o) - 1))
        m = np.concatenate(m)
        names = [x.split()[0] for x in MEASURES.split(", ")]
        return pa.StructArray.from_arrays([*(pa.array(np.ascontiguousarray(m[:, j])) for j in range(5)), pa.array(np.concatenate(s))], [*names, "score"])

    return quality_rules.asNondeterministic()(text)


def quality_rules(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, measures, base_failed, score, kept) per row."""
    out = docs.select(F.col(id_col).alias("doc_id"), judge(F.col(text_col), model).alias("q")).select("doc_id", "q.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= keep_at))
