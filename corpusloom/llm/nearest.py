"""Exact nearest neighbours by inner product: a block matrix join (operator 11).

Queries are cut into blocks and candidates into stripes; a cell of that grid is
one piece of work of one task, which holds the block's queries (at most about
BLOCK_BYTES of vectors) and lets the stripe's candidates stream past in tiles.
Vectors are rounded to int8 with a scale of their own.  A tile is the product
of int8 codes (exact: sums stay below 2^24, so single precision holds them);
with the norms of what rounding left over, the Cauchy-Schwarz inequality bounds
how far a tile's entry can lie from the true product.  Pairs whose upper bound
reaches the query's k-th best are recomputed in double precision from the
original vectors; the others cannot enter the list.  Lists of the stripes are
merged by heaps, as a stream in order of query.

Every query is compared with every candidate, so work grows as their product;
what a task holds doesn't grow.  Stripes follow the number of candidates, and
lists grow by k entries a query and stripe.  Cells are dealt by hashes, so a
lost executor's cells come out alike elsewhere.

Values: vectors that are null, empty, all zero, or hold null or non-finite
components take no part.  Vectors of another length than the query's are no
candidates for it.  Rows equal in id and vector count once; rows that share the
query's id are its own, whatever their vector; each distinct vector of an id
that is a query is asked on its own and gives a list of its own.  A null id is
never a query, and comes last among ties.  Of equal vectors only the k + 1
smallest ids are kept as candidates, which loses nothing: one of them at most
is the query's own.  An empty table, or one row alone, gives an empty result.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources import scratch

BLOCK_BYTES = 32 << 20  # of a block's queries, in single precision
STRIPE_ROWS, LEAST_STRIPE = 1 << 20, 4096
TILE = 1024
LEVELS = 127
MOST_PARTS = 20_000
NULL_ID = np.iinfo(np.int64).max  # stands for a null id inside tasks; ids are smaller
LISTS = "query_id long, version long, found array<struct<score:double,vec_id:long>>"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class Codes:
    """Vectors rounded to int8, with what is needed to bound the rounding's effect on a product."""

    def __init__(self, vectors: np.ndarray):
        self.scale = np.abs(vectors).max(1) / LEVELS
        self.scale[self.scale == 0] = 1.0  # all components below what a scale can express
        q = np.clip(np.rint(vectors / self.scale[:, None]), -LEVELS, LEVELS)
        self.int8 = q.astype(np.int8)
        near = q * self.scale[:, None]
        self.near = np.linalg.norm(near, axis=1)
        self.left = np.linalg.norm(vectors - near, axis=1)
        self.norm = np.linalg.norm(vectors, axis=1)


def tile(a: Codes, b: Codes, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Products of the codes of a[rows] and b at their scale, and how far each can lie from the true product.

    x.y - x'.y' = (x - x').y + x'.(y - y'), so the distance is at most |x - x'||y| + |x'||y - y'|, plus what double precision may round.
    """
    dim = a.int8.shape[1]
    total = np.zeros((rows.stop - rows.start, len(b.int8)))
    for at in range(0, dim, 1024):  # 1,024 products of two int8 stay below 2^24
        total += a.int8[rows, at : at + 1024].astype(np.float32) @ b.int8[:, at : at + 1024].astype(np.float32).T
    total *= a.scale[rows, None]
    total *= b.scale
    off = a.left[rows, None] * b.norm + a.near[rows, None] * b.left + (1e-14 * (dim + 8)) * (a.norm[rows, None] * b.norm)
    return total, off


class Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, versions: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.versions, self.vectors, self.k = ids, versions, vectors, k
        self.codes = Codes(vectors)
        n = len(ids)
        self.score, self.found = np.full((n, k), -np.inf), np.full((n, k), NULL_ID)
        self.filled = np.zeros(n, np.int64)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for c in range(0, len(ids), TILE):
            part = Codes(vectors[c : c + TILE])
            for q in range(0, len(self.ids), TILE):
                self._tile(slice(q, min(q + TILE, len(self.ids))), ids[c : c + TILE], vectors[c : c + TILE], part)

    def _tile(self, rows: slice, ids: np.ndarray, vectors: np.ndarray, codes: Codes) -> None:
        near, off = tile(self.codes, codes, rows)
        least = np.where(self.filled[rows] == self.k, self.score[rows, -1], -np.inf)
        if len(ids) > self.k and (self.filled[rows] < self.k).any():  # no list yet: the k-th largest lower bound
            low = near - off
            low[self.ids[rows, None] == ids] = -np.inf
            least = np.maximum(least, np.partition(low, -self.k, axis=1)[:, -self.k])
        q, c = np.nonzero(near + off >= least[:, None])
        q += rows.start
        other = (self.ids[q] != ids[c]) | (ids[c] == NULL_ID)
        q, c = q[other], c[other]
        if not len(q):
            return
        score = np.concatenate([(self.vectors[q[i : i + 65536]] * vectors[c[i : i + 65536]]).sum(1) for i in range(0, len(q), 65536)])
        hit = np.unique(q)
        old = self.filled[hit]
        at, col = np.nonzero(np.arange(self.k) < old[:, None])
        q, score, found = np.concatenate([q, hit[at]]), np.concatenate([score, self.score[hit[at], col]]), np.concatenate([ids[c], self.found[hit[at], col]])
        order = np.lexsort((found, -score, q))
        q, score, found = q[order], score[order], found[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = place < self.k
        self.score[q[keep], place[keep]], self.found[q[keep], place[keep]] = score[keep], found[keep]
        self.filled[hit] = np.minimum(np.diff(np.r_[first, len(q)]), self.k)

    def lists(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.ids), 4096):
            hi = min(lo + 4096, len(self.ids))
            some = np.arange(self.k) < self.filled[lo:hi, None]
            pairs = pa.StructArray.from_arrays([pa.array(self.score[lo:hi][some]), _ids(self.found[lo:hi][some])], ["score", "vec_id"])
            found = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some.sum(1))].astype(np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[lo:hi]), pa.array(self.versions[lo:hi]), found], ["query_id", "version", "found"])


def _ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == NULL_ID)


def _cells(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of cell, length, and queries first."""
        here, held, best = None, [], None
        for batch in batches:
            cell, dim, role, version = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "dim", "role", "version"))
            ids = batch.column("id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(dim) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *change], [*change, len(cell)], strict=True):
                if lo == hi:
                    continue
                if here != (cell[lo], dim[lo]):
                    if best:
                        yield from best.lists()
                    here, held, best = (cell[lo], dim[lo]), [], None
                vectors = batch.column("vector").slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(hi - lo, -1)
                if not role[lo]:
                    held.append((ids[lo:hi], version[lo:hi], vectors))
                elif held or best:
                    best = best or Best(*map(np.concatenate, zip(*held, strict=True)), k)
                    held = []
                    best.offer(ids[lo:hi], vectors)
        if best:
            yield from best.lists()

    return run


def _merged(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's lists follow one another; each is sorted, best first."""
        here, best, out = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                query, rank, score, found = map(np.array, zip(*out, strict=True))
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(rank.astype(np.int32)), _ids(found), pa.array(score)], ["query_id", "rank", "vec_id", "score"])

        def close() -> None:
            out.extend((here[0], i, -score, found) for i, (score, found) in enumerate(best, 1))

        for batch in batches:
            query, version = batch.column("query_id").to_pylist(), batch.column("version").to_pylist()
            lists = batch.column("found")
            pairs, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            score = (-pairs.field("score").to_numpy(zero_copy_only=False)).tolist()
            found = pairs.field("vec_id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).tolist()
            begin = 0
            for key, end in zip(zip(query, version, strict=True), ends, strict=True):
                if key != here:
                    if here:
                        close()
                    if len(out) > 50_000:
                        yield from flush()
                    here, best = key, []
                more = heapq.merge(best, zip(score[begin:end], found[begin:end], strict=True))
                best = [x for x, _ in zip(more, range(k))]
                begin = end
        if here:
            close()
        yield from flush()

    return run


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each row that ``is_query`` (over the column ``id``) holds for."""
    spark = df.sparkSession
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast(kind).alias("vector"))
    rows = rows.filter(usable(F.col("vector")))
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last()))
    few = scratch.written(rows.withColumn("place", place).filter(F.col("place") <= k + 1).select("id", "vector").dropDuplicates(["vector", "id"]), "candidates")
    asked = scratch.written(rows.filter(is_query).dropDuplicates(["id", "vector"]), "asked")
    n, dim = few.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    n_asked = asked.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_asked * 4 * dim // BLOCK_BYTES))
    stripes = max(1, -(-n // STRIPE_ROWS), min(-(-n // LEAST_STRIPE), -(-parts // blocks)))

    def dealt(d: DataFrame, role: int) -> DataFrame:
        own, other = (blocks, stripes) if role == 0 else (stripes, blocks)
        mine = F.pmod(F.xxhash64(F.lit(role), "id", "vector"), F.lit(own))
        d = d.select("id", "vector", mine.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long"))).alias("other"))
        cell = F.col("own") * stripes + F.col("other") if role == 0 else F.col("other") * stripes + F.col("own")
        return d.select(cell.alias("cell"), F.size("vector").alias("dim"), F.lit(role).alias("role"), "id", F.xxhash64("vector").alias("version"), "vector")

    cells = dealt(asked, 0).unionByName(dealt(few, 1))
    tasks = min(blocks * stripes, MOST_PARTS)
    cells = cells.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "dim", "role")
    lists = cells.mapInArrow(_cells(k), LISTS)
    lists = lists.repartition("query_id", "version").sortWithinPartitions("query_id", "version")
    return lists.mapInArrow(_merged(k), "query_id long, rank int, vec_id long, score double")
