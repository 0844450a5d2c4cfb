"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources import scratch


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u")
    return larger.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)  # here v < u on every edge
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _seal(edges: DataFrame) -> tuple:
    """A number and a sum of hashes that tell one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of an edge; component is its smallest node.

    Minima are aggregated before the shuffle, and no node's neighbours are ever
    gathered, so a hub with a third of all edges costs no more than others.
    Every round ends in a written table; the loop ends when the star forest
    stands still.  Null ends and self-loops are dropped; no edges give no rows.
    """
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"), F.col(src).alias("_a"), F.col(dst).alias("_b"))
    now = scratch.written(pairs.filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct(), "edges")
    seal = _seal(now)
    for _ in range(max_rounds):
        if not seal[0]:
            break
        new = scratch.written(_small_star(_large_star(now)), "edges")
        scratch.drop(now)
        now, before, seal = new, seal, _seal(new)
        if seal == before:  # a star forest stays as it is
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
