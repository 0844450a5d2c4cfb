"""Operators on an ordered corpus: budgets, strides, running sums, without one task that sees all rows.

The order column is cut into blocks at quantiles, one for every million rows;
beyond MOST_BLOCKS each block is cut again at quantiles of its own, so that a
block keeps its size up to MOST_BLOCKS ** 2 blocks, some 4 * 10**12 rows.  Block
totals, a row a block, are summed up and joined back, and windows run inside
blocks only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources import scratch

LEAST_BLOCKS, MOST_BLOCKS, BLOCK_ROWS = 64, 2048, 1_000_000


def _blocked(df: DataFrame, order: str, block_rows: int) -> DataFrame:
    asked = [i / MOST_BLOCKS for i in range(1, MOST_BLOCKS)]
    rows, cuts = df.agg(F.count("*"), F.percentile_approx(order, asked, 10 * MOST_BLOCKS)).first()
    if not cuts:
        return df.withColumn("_block", F.lit(0))
    wanted = max(LEAST_BLOCKS, -(-rows // block_rows))
    blocks = min(MOST_BLOCKS, wanted)
    marks = sorted({cuts[MOST_BLOCKS * i // blocks - 1] for i in range(1, blocks)})
    # two steps, so that a row is compared with some tens of marks, not all
    step = max(1, math.isqrt(len(marks)))
    runs = [marks[i : i + step] for i in range(0, len(marks), step)]
    run = F.size(F.filter(F.array(*[F.lit(r[0]) for r in runs]), lambda c: c <= F.col(order)))
    inner = F.get(F.array(*[F.array(*map(F.lit, r)) for r in runs]), run - 1)
    df = df.withColumn("_block", F.when(run > 0, (run - 1) * step + F.size(F.filter(inner, lambda c: c <= F.col(order)))).otherwise(F.lit(0)))
    return _cut_again(df, order, min(MOST_BLOCKS, -(-wanted // MOST_BLOCKS)))


def _cut_again(df: DataFrame, order: str, parts: int) -> DataFrame:
    """Cut each block into about equal parts, in order.  The marks, at most MOST_BLOCKS rows of as many numbers, are written, so that every reading of the rows sees the same ones."""
    if parts == 1:
        return df
    asked = F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts)
    marks = scratch.written(df.groupBy("_block").agg(F.array_sort(F.array_distinct(asked)).alias("_marks")), "marks")
    part = F.coalesce(F.size(F.filter("_marks", lambda c: c <= F.col(order))), F.lit(0))
    marked = df.join(F.broadcast(marks.withColumnRenamed("_block", "_of")), F.col("_block") == F.col("_of"))
    # nulls, which order first, stay in the first part
    return marked.withColumn("_block", F.col("_block") * parts + F.greatest(part, F.lit(0))).drop("_of", "_marks")


def with_running(df: DataFrame, order: str, value: Column, name: str, block_rows: int = BLOCK_ROWS, ties: list[str] | None = None, within: str | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows up to each row, in ascending order; with ``within``, over those of the same value there, however many these are."""
    df = _blocked(df.withColumn("_value", value), order, block_rows)
    group = F.col(within) if within else F.lit(0)
    df = df.withColumn("_group", group)
    totals = df.groupBy("_group", "_block").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    offsets = totals.select(F.col("_group").alias("_g"), F.col("_block").alias("_b"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_group", "_block").orderBy(order, *(ties or [])).rowsBetween(Window.unboundedPreceding, 0)
    offsets = offsets if within else F.broadcast(offsets)
    out = df.join(offsets, (F.col("_block") == F.col("_b")) & F.col("_group").eqNullSafe(F.col("_g"))).withColumn(name, F.col("_offset") + F.sum("_value").over(inside))
    return out.drop("_block", "_offset", "_value", "_group", "_g", "_b")


def with_earlier(df: DataFrame, order: str, value: str, name: str, how: str = "last", within: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the last, or the largest, ``value`` of all rows before each row, null for the first; with ``within``, of those of the same value there, however many these are."""
    df = _blocked(df, order, block_rows).withColumn("_group", F.col(within) if within else F.lit(0))
    end = F.max(value) if how == "max" else F.max_by(value, order)
    ends = df.groupBy("_group", "_block").agg(end.alias("_end"))
    blocks = Window.partitionBy("_group").orderBy("_block")  # a row a block
    came = F.max("_end").over(blocks.rowsBetween(Window.unboundedPreceding, -1)) if how == "max" else F.lag("_end").over(blocks)
    carried = ends.select(F.col("_group").alias("_g"), F.col("_block").alias("_b"), came.alias("_came"))
    inside = Window.partitionBy("_group", "_block").orderBy(order)
    own = F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)) if how == "max" else F.lag(value).over(inside)
    first = F.row_number().over(inside) == 1
    carried = carried if within else F.broadcast(carried)
    out = df.join(carried, (F.col("_block") == F.col("_b")) & F.col("_group").eqNullSafe(F.col("_g")))
    out = out.withColumn(name, F.greatest(own, F.col("_came")) if how == "max" else F.when(first, F.col("_came")).otherwise(own))
    return out.drop("_block", "_group", "_g", "_b", "_came")


def budget(df: DataFrame, order: str, size: Column, limit: int, keep_crossing: bool = True) -> DataFrame:
    """Rows in order until their sizes sum up to ``limit``; the row that crosses it is kept or not."""
    run = with_running(df.withColumn("_size", size), order, F.col("_size"), "_run")
    kept = run.filter(F.col("_run") - F.col("_size") < limit) if keep_crossing else run.filter(F.col("_run") <= limit)
    return kept.drop("_run", "_size")


def stride(df: DataFrame, order: str, k: int) -> DataFrame:
    """Rows k, 2k, 3k, ... in order."""
    return with_running(df, order, F.lit(1), "_n").filter(F.col("_n") % k == 0).drop("_n")


def numbered(df: DataFrame, order: str, name: str = "row", within: str | None = None) -> DataFrame:
    """Add row numbers from 0, for each value of ``within`` where it is given."""
    return with_running(df, order, F.lit(1), name, within=within).withColumn(name, F.col(name) - 1)


def chunked(df: DataFrame, order: str, size: int, name: str = "chunk") -> DataFrame:
    """Number consecutive chunks of ``size`` rows from 0."""
    return numbered(df, order, "_n").withColumn(name, F.floor(F.col("_n") / size)).drop("_n")


def block_means(df: DataFrame, order: str, values: list[str], k: int) -> DataFrame:
    """Means over runs of k rows; the last run may be shorter."""
    rows = chunked(df, order, k, "block")
    return rows.groupBy("block").agg(*[F.avg(v).alias(v) for v in values], F.max(order).alias(order), F.count("*").alias("n"))


def keep_by_position(df: DataFrame, order: str, side: DataFrame, accepted: Column) -> DataFrame:
    """Rows whose place, from 0, has an accepted entry in a side table (idx, ...); an equi join on the place."""
    good = side.filter(accepted).select(F.col("idx").alias("_row"))
    return numbered(df, order, "_row").join(good, "_row", "left_semi").drop("_row")


def examples(df: DataFrame, order: str, words: Column, first: int, long_over: int | None = None) -> DataFrame:
    """The first texts in order, or the first of more than ``long_over`` words, to look at."""
    return (df.filter(words > long_over) if long_over is not None else df).orderBy(order).limit(first)
