"""Vector code compression: product codes with integer codebooks (operator 13).

A component x becomes floor(scale * x).  A vector is cut into equal parts; each
part position has a codebook, which starts as that part of the rows with the
smallest ids, and is refined by rounds of assignment and componentwise
floor(sum / count).  A vector's code is the index of the nearest entry of each
part.

Nearest entries are found coarse to fine.  A part is cut into 1, 2, 4 ...
segments; with the segments' means and the norms of what remains beside them,
len * (mean - mean')^2 + (rest - rest')^2 summed over the segments never
exceeds the squared distance.  The entry with the lowest coarse bound gives a
distance that some entry reaches; entries whose bound lies above it are dropped
at each level, with room for what double precision rounds, so none that could
win or tie goes.  The survivors' distances are computed exactly, in integers;
ties go to the lower index.

Each round is one pass over the rows in Spark.  A task adds up its parts by
entry, so what is shuffled are parts * entries sums a task; the codebooks, of a
size that the vectors' length fixes, are all that reaches the driver.

Values: rows whose vector is null, empty, or holds null or non-finite
components go.  The length coded is the most frequent one (the longer on ties);
it must be a multiple of the number of parts.  Rows of another length stay,
with null code and error.  Rows with one id are ordered by vector where the
first entries are drawn, null ids last; fewer rows than entries make a smaller
codebook, repeated entries stay and the first of them wins.  Components of
2^26 / scale and beyond raise an error, since squared distances would not fit.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources import scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MOST = 1 << 26
ROWS_AT_ONCE = 1024
BROADCAST_LABELS = 100_000


def kept(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & (F.size(vector) > 0), F.lit(False))


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    x = np.floor(vectors.astype(np.float64) * scale)
    if x.size and np.abs(x).max() >= MOST:
        raise ValueError(f"a component reaches {MOST} / {scale}: squared distances would not fit")
    return x.astype(np.int64)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """(..., 2 * segments): of each segment of the last axis, its mean times the root of its length, and the norm of what remains."""
    cuts = np.linspace(0, x.shape[-1], segments + 1).astype(int)
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        part = x[..., lo:hi].astype(np.float64)
        mean = part.mean(-1)
        out += [mean * np.sqrt(hi - lo), np.sqrt(((part - mean[..., None]) ** 2).sum(-1))]
    return np.stack(out, -1)


class Codebooks:
    """entries: (parts, entries, length of a part), int64."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        length = entries.shape[2]
        self.levels = [s for s in (1 << k for k in range(16)) if s == 1 or 2 * s <= length]
        self.features = [segment_features(entries, s) for s in self.levels]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of, and exact squared distance to, the nearest entry of each part; x: (rows, parts, length)."""
        n, parts, _ = x.shape
        own = [segment_features(x, s) for s in self.levels]
        bound = sum((own[0][:, :, None, f] - self.features[0][None, :, :, f]) ** 2 for f in range(own[0].shape[2]))
        row, part = np.divmod(np.arange(n * parts), parts)
        first = bound.reshape(n * parts, -1).argmin(1)
        reached = ((x[row, part] - self.entries[part, first]) ** 2).sum(1)
        cell, entry = np.nonzero(self._may_win(bound.reshape(n * parts, -1), reached[:, None]))
        for mine, theirs in zip(own[1:], self.features[1:], strict=True):
            low = ((mine.reshape(n * parts, -1)[cell] - theirs[part[cell], entry]) ** 2).sum(1)
            on = self._may_win(low, reached[cell])
            cell, entry = cell[on], entry[on]
        distance = ((x[row[cell], part[cell]] - self.entries[part[cell], entry]) ** 2).sum(1)
        begin = np.searchsorted(cell, np.arange(n * parts))
        least = np.minimum.reduceat(distance, begin)
        index = np.minimum.reduceat(np.where(distance == least[cell], entry, self.entries.shape[1]), begin)
        return index.reshape(n, parts), least.reshape(n, parts)

    @staticmethod
    def _may_win(bound: np.ndarray, reached: np.ndarray) -> np.ndarray:
        return bound * (1 - 1e-9) - 1e-3 <= reached

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _vectors(batch: pa.RecordBatch, scale: int, parts: int, dim: int) -> Iterator[tuple[int, int, np.ndarray]]:
    for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
        some = batch.column("vector").slice(lo, ROWS_AT_ONCE)
        yield lo, lo + len(some), integers(some.flatten().to_numpy(zero_copy_only=False), scale).reshape(len(some), parts, dim // parts)


def _summed(books: Codebooks, scale: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, length = books.entries.shape
        total, n = np.zeros((parts * size, length), np.int64), np.zeros(parts * size, np.int64)
        for batch in batches:
            for _, _, x in _vectors(batch, scale, parts, dim):
                at = (books.assign(x)[0] + np.arange(parts) * size).reshape(-1)
                np.add.at(total, at, x.reshape(-1, length))
                n += np.bincount(at, minlength=parts * size)
        used = np.flatnonzero(n)
        if len(used):
            sums = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(used) + 1) * length, length, dtype=np.int32)), pa.array(total[used].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), sums], ["entry", "n", "sums"])

    return run


def _coded(books: Codebooks, scale: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, _, x in _vectors(batch, scale, books.entries.shape[0], dim):
                code, distance = books.assign(x)
                codes += [row.tobytes().hex() for row in code.astype(np.uint8)]
                errors.append(distance.sum(1))
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    return run


def train(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of rows (id, vector), whose vectors all have length dim."""
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    start = integers(np.array([r["vector"] for r in first]), scale).reshape(len(first), parts, dim // parts)
    books = Codebooks(start.transpose(1, 0, 2).copy())
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(_summed(books, scale, dim), "entry int, n long, sums array<long>")
        cell = F.posexplode("sums").alias("place", "value")
        found = sums.select("entry", "n", cell).groupBy("entry", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()  # parts * entries * length of a part rows
        new = books.entries.reshape(-1, dim // parts).copy()
        for r in found:
            new[r["entry"], r["place"]] = r["value"] // r["n"]
        books = Codebooks(new.reshape(books.entries.shape))
    return books


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of each row kept; error is summed by label for label_error."""
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(df[id_col].alias("id"), df[label_col].alias("label"), df[vector_col].cast(kind).alias("vector")).filter(kept(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    none = df.sparkSession.createDataFrame([], rows.select("id", "label").schema).select("*", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    dim = sizes[0]["dim"] if sizes else None
    if dim is None:
        return none.select("*", F.lit(None).cast("long").alias("label_error"), F.lit(None).cast("string").alias("codebooks_sha256"))
    fit = rows.filter(F.size("vector") == dim)
    books = train(fit, dim, parts, entries, rounds, scale)
    out = fit.mapInArrow(_coded(books, scale, dim), none.schema)
    odd = rows.filter(F.size("vector") != dim).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = scratch.written(out.unionByName(odd), "codes")
    by = scratch.written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    few = by.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS  # else an ordinary join, whose hot keys Spark splits
    return coded.join(F.broadcast(by) if few else by, F.col("label").eqNullSafe(F.col("of")), "left").select("id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
