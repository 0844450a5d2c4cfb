"""Exact and MinHash deduplication."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.operators.components import connected_components
from corpusloom.sources import scratch

BANDS, ROWS, SHINGLE = 14, 8, 5


def exact(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The first row, in order, of each text; only hashes and ids are shuffled and compared.

    All null texts count as one text.  A null id comes after every other, so a
    text that has no other keeps one of its rows; of rows that share the first
    id and the text one stays.
    """
    keyed = df.withColumn("_h", F.sha2(F.col(text), 256))
    each = keyed.select("_h", F.col(order).alias("_o")).groupBy("_h", "_o").agg(F.count("*").alias("n"))
    first = scratch.written(each.groupBy("_h").agg(F.min(F.struct(F.col("_o").isNull().alias("none"), "_o", "n")).alias("f")).select("_h", "f._o", "f.n"), "first")

    def rows(of: DataFrame) -> DataFrame:
        return keyed.join(of.select(F.col("_h").alias("_g"), "_o"), F.col("_h").eqNullSafe(F.col("_g")) & F.col(order).eqNullSafe(F.col("_o")), "left_semi")

    out = rows(first.filter("n = 1"))
    many = first.filter("n > 1")
    if many.limit(1).count():
        out = out.unionByName(rows(many).dropDuplicates(["_h", order]))
    return out.drop("_h")


def repeats(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Second and later occurrences of a key."""
    keyed = df.withColumn("_k", key)
    first = keyed.groupBy("_k").agg(F.min(order).alias("_first"))
    return keyed.join(first, keyed["_k"].eqNullSafe(first["_k"])).filter(F.col(order) > F.col("_first")).select(*df.columns)


def clashing_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share their key with another; empty for a sound table."""
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return df.join(many, keys, "left_semi")


def _bands(data: np.ndarray, off: np.ndarray, bands: int, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts x bands) hashes of MinHash minima, and which texts have a shingle."""
    w = K.Words(data, off)
    h, at = K.windows(w.hashes(fold=True), w.row, width)
    row = np.searchsorted(at, w.row)
    has = np.diff(row) > 0
    out = np.zeros((len(off) - 1, bands), np.uint64)
    if not len(h):
        return out, has
    heads = row[:-1][has]
    for b in range(bands):
        acc = np.full(int(has.sum()), b + 1, np.uint64)
        for r in range(rows):
            seed = K.U((b * rows + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            acc = K.mix(acc * K.U(31) ^ np.minimum.reduceat(K.mix(h ^ seed), heads))
        out[has, b] = acc
    return out, has


def band_hashes(text: Column, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> Column:
    """One hash for each band of the MinHash signature of a text's word shingles; null for a text of fewer words than a shingle."""

    @F.arrow_udf("array<bigint>")
    def minhash_bands(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        parts = [_bands(d, o, bands, rows, width) for _, _, d, o in K.pieces(data, off)]
        if not parts:
            return pa.array([], pa.list_(pa.int64()))
        values, has = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        at = pa.array(np.arange(len(values) + 1, dtype=np.int32) * bands)
        return pa.ListArray.from_arrays(at, pa.array(values.view(np.int64).ravel()), mask=pa.array(~has))

    return minhash_bands(text)


def bucket_edges(signed: DataFrame, order: str, within: list[str] | None = None) -> DataFrame:
    """(src, dst) from the smallest id of each shared band to the others: a star, not all pairs.  signed: (order, bands, and the columns of within, inside which alone texts are compared)."""
    keys = [*(within or []), "band", "h"]
    cells = signed.select(F.col(order).alias("dst"), *(within or []), F.posexplode("bands").alias("band", "h"))
    stars = cells.groupBy(*keys).agg(F.min("dst").alias("src"), F.count("*").alias("n")).filter("n > 1")
    return cells.join(stars, keys).filter("src <> dst").select("src", "dst").distinct()


def minhash_clusters(df: DataFrame, text: str = "text", order: str = "doc_id", within: list[str] | None = None) -> DataFrame:
    """(order, cluster): the smallest id of each cluster of near copies; single texts are their own cluster.

    ``within`` names columns that near copies must share (not null).  Equal
    signatures collapse before the bands are spread out, so copies cost one row.
    """
    within = list(within or [])
    signed = scratch.written(df.select(order, *within, band_hashes(F.col(text)).alias("bands")), "signatures")
    kinds = scratch.written(signed.filter("bands is not null").groupBy(*within, "bands").agg(F.min(order).alias("low")), "kinds")
    roots = connected_components(bucket_edges(kinds.withColumnRenamed("low", order), order, within))
    named = kinds.join(roots, kinds.low == roots.node, "left").select(*within, "bands", F.coalesce("component", "low").alias("cluster"))
    return signed.join(named, [*within, "bands"], "left").select(order, F.coalesce("cluster", F.col(order)).alias("cluster"))


def minhash(df: DataFrame, text: str = "text", order: str = "doc_id", within: list[str] | None = None) -> DataFrame:
    """One row of each cluster of near copies."""
    away = minhash_clusters(df, text, order, within).filter(F.col("cluster") != F.col(order)).select(order)
    return df.join(away, order, "left_anti")


def last_of_group(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each group that comes last in an order."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", at).filter("_r = 1").drop("_r")
