"""Which language a text is in: a naive Bayes model of byte n-grams.

Training counts the n-grams of every labelled text in Spark, by language and
slot; the sums, a number that languages and slots fix, make the model.  Scores
are log-likelihoods a character, made shares of the candidates, as a published
identifier's ranks are, so they don't fall with a text's length.  A text all in
capitals is read in small letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K

ORDERS = (1, 2, 3, 4)
SLOTS = 1 << 15
SMOOTH = 0.5
MOST_LANGUAGES = 200


class Model(NamedTuple):
    """languages in order of name; logs: (languages, orders * SLOTS)."""

    languages: list[str]
    logs: np.ndarray


def slots(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the slot of every n-gram that lies in one row, and where it begins."""
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint64)
    end = np.repeat(off[1:], np.diff(off))
    gram = np.zeros(len(data), np.uint64)
    for k, n in enumerate(ORDERS):
        gram = gram | padded[k : k + len(data)] << np.uint64(8 * k)
        at = np.flatnonzero(np.arange(len(data)) + n <= end)
        yield (K.mix(gram[at] + np.uint64(n << 40)) >> np.uint64(49)).astype(np.int64) + k * SLOTS, at


def as_read(text: Column) -> Column:
    """A text all in capitals in small letters; null as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when((text == F.upper(text)) & (text != F.lower(text)), F.lower(text)).otherwise(text)


def train(df: DataFrame, language: str = "lang", text: str = "text") -> Model:
    """A model of the rows with a language, all of whose texts count; at most MOST_LANGUAGES languages."""
    rows = df.select(F.col(language).alias("language"), as_read(F.col(text)).alias("text")).filter("language is not null")
    names = sorted(r.language for r in rows.select("language").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), len(ORDERS) * SLOTS), np.int64)
        for batch in batches:
            of = np.array([names.index(x) for x in batch.column("language").to_pylist()], np.int64)
            data, off = K.text_bytes(batch.column("text"))
            for lo, hi, d, o in K.pieces(data, off):
                row = np.repeat(of[lo:hi], np.diff(o))
                for slot, at in slots(d, o):
                    total += np.bincount(row[at] * total.shape[1] + slot, minlength=total.size).reshape(total.shape)
        for k in range(len(names)):
            used = np.flatnonzero(total[k])
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(total[k, used])], ["language", "slot", "n"])

    counts = rows.mapInArrow(count, "language int, slot int, n long").groupBy("language", "slot").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    n = np.zeros((len(names), len(ORDERS), SLOTS))
    n.reshape(len(names), -1)[found["language"].to_numpy(), found["slot"].to_numpy()] = found["n"].to_numpy()
    n += SMOOTH
    return Model(names, np.log(n / n.sum(2, keepdims=True)).reshape(len(names), -1))


def scores(text: Column, model: Model, among: list[str] | None = None) -> Column:
    """array<struct<language, score>> of the candidates, the likeliest first, ties by name; scores sum to 1."""
    chosen = [k for k, x in enumerate(model.languages) if among is None or x in among]
    if not chosen:
        raise ValueError(f"no model for {among}")
    names, logs = [model.languages[k] for k in chosen], np.ascontiguousarray(model.logs[chosen].T)

    @F.arrow_udf("array<struct<language:string,score:double>>")
    def score(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        total = np.zeros((len(col), len(names)))
        for lo, hi, d, o in K.pieces(data, off):
            row = np.repeat(np.arange(hi - lo), np.diff(o))
            for slot, at in slots(d, o):
                for k in range(len(names)):
                    total[lo:hi, k] += np.bincount(row[at], logs[slot, k], hi - lo)
        chars = np.diff(K.code_points(data, off)[1])
        share = np.exp(total / np.maximum(chars, 1)[:, None])
        share /= share.sum(1, keepdims=True)
        order = np.argsort(-share, axis=1, kind="stable")
        pairs = pa.StructArray.from_arrays([pa.array(names).take(pa.array(order.reshape(-1))), pa.array(np.take_along_axis(share, order, 1).reshape(-1))], ["language", "score"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1, dtype=np.int32) * len(names)), pairs)

    return score(as_read(text))
