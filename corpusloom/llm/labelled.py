"""Bounded samples of labelled texts, and small linear models trained on the driver.

Corpus-wide work stays in Spark; only a documented, bounded number of labelled
rows reaches the driver, chosen by a hash of their id and so alike at any size
and partitioning.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def fold_of_id(value: int, folds: int) -> int:
    return zlib.crc32(str(value).encode()) % folds


def labelled_ids(labels: DataFrame, label: str, allowed: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of every labelled id; rows with a null id or a label that is not 0 or 1 don't count, nor does an id with both labels."""
    ids = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    if allowed is not None:
        ids = ids.filter(allowed)
    return ids.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to ``per_class`` labelled rows (doc_id, text, label) of each label.

    Labels: rows with a null id or a label that is not 0 or 1 don't count; an
    id with both labels doesn't count.  The chosen ids number at most
    2 * per_class, so they may be broadcast; texts found for them are cut to as
    many rows again, in hash order, where ids repeat.
    """
    ids = labelled_ids(labels, label, allowed, id_col)
    order = [F.xxhash64(F.lit(f"sample of {label}"), "doc_id"), F.col("doc_id")]
    chosen = [ids.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    few = chosen[0].union(chosen[1])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(few), "doc_id")
    return found.orderBy(*order, F.xxhash64("text")).limit(2 * per_class)


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 60, intercept: bool = True) -> np.ndarray:
    """Newton's method for a small dense logistic regression; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))]) if intercept else x
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    if intercept:
        ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        d = np.linalg.solve(h, g)
        w -= d * min(1.0, 5 / (np.abs(d).max() + 1e-12))
        if np.abs(d).max() < 1e-6:
            break
    return w


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling (slope at least a little positive, intercept) with smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 1.0, float(np.log((pos + 1) / (neg + 1)))
    spread = score.std() or 1.0
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = logistic((score / spread)[:, None], t, l2=1e-3)
    return max(a, 1e-3) / spread, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
