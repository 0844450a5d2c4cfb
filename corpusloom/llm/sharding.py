"""Two-pass external shuffle into shards (operator 4).

Pass one scatters rows uniformly into buckets by a seeded hash of the whole
row; a bucket is a size that one task can hold.  Pass two takes a bucket into
memory, puts its rows in an order drawn by a Fisher-Yates shuffle from the seed
and the bucket, and writes them.  Buckets follow one another in the global
order, whose places are dealt to the shards in turn: counts differ by one at
most (law ``rows``), and a shard's slots have no gaps.  Each shard is a folder
of its own; its files, read in the order of their names, hold slots 0, 1, 2 and
so on.

The number of buckets follows from the rows' number and bytes alone, so the
same rows and seed give the same shards and slots on any cluster, under any
partitioning.  Where each bucket begins is summed over blocks of buckets, and
reaches the bucket's task as a row that opens it; nothing about buckets or rows
goes to the driver but the two totals.

Rows that are equal in all columns can't be told apart; a row with more than
HEAVY such copies is sent once with its count, and the copies, numbered, are
scattered over all buckets.  Null ids and texts are values like any other: rows
that differ only in which column is null are different rows.  A very long text
is moved whole; the bucket that holds it is larger than the others.  An empty
table gives an empty result, and clashing column names don't matter, since a
row travels as one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources import scratch

BUCKET_BYTES = 16 << 20
SPREAD, LEAST_ROWS = 1024, 64  # small tables have up to SPREAD buckets too, of LEAST_ROWS rows
TASK_BYTES = 128 << 20
HEAVY = 1000
#: So that no two different values are written alike.
WHOLE = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
BLOCK = 1024
OUT_BYTES = 4 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The order of n rows after the shuffle: which row comes first, second and so on; NumPy's permutation is a Fisher-Yates shuffle."""
    return np.random.default_rng([seed, bucket]).permutation(n)


def bucket_count(rows: int, size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(1, -(-size // bucket_bytes), min(SPREAD, rows // LEAST_ROWS))


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """rows (record, key, size), with the copies of a heavy row scattered by their number.

    The key, a hash, only says where heavy rows may be; rows are collapsed where the records themselves are equal, so rows that share a hash by chance keep their own.
    """
    heavy = rows.groupBy("key").agg(F.count("*").alias("copies")).filter(F.col("copies") > HEAVY)
    heavy = scratch.written(heavy, "heavy")
    n = heavy.count()
    if not n:
        return rows
    keys = F.broadcast(heavy.select("key")) if n < 100_000 else heavy.select("key")
    own = rows.schema["record"].dataType.simpleString()
    exact = F.to_json("record", WHOLE) if any(k in own for k in ("map<", "float", "double")) else F.lit("")  # 0.0 and -0.0, or maps in another order, count as equal elsewhere
    one = rows.join(keys, "key", "left_semi").groupBy("key", "record", exact.alias("exact")).agg(F.first("record").alias("own"), F.first("size").alias("size"), F.count("*").alias("copies"))
    one = one.select("key", F.col("own").alias("record"), "size", "copies")
    many = one.select("record", F.col("key").alias("_k"), "size", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_n"))
    return rows.join(keys, "key", "left_anti").select("record", "key", "size").unionByName(many.select("record", F.xxhash64("_k", "_n").alias("key"), "size"))


def external_shuffle(df: DataFrame, shards: int, path: str, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Write df's rows as (record, slot), by shard, in shuffled order under path, and read them as (record, slot, shard).

    ``record`` is a struct of df's columns, so no name can clash.
    """
    spark = df.sparkSession
    record = F.struct(*[df[c] for c in df.columns])
    nested = any(isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType) for f in df.schema)  # hashes skip nulls inside these, and don't take maps
    rows = df.select(record.alias("record"), F.xxhash64(F.lit(seed), F.to_json(record, WHOLE)).alias("key") if nested else F.xxhash64(F.lit(seed), *[x for c in df.columns for x in (df[c].isNull(), df[c])]).alias("key"), (F.coalesce(F.octet_length(df[text_col]), F.lit(0)) + 64).cast("long").alias("size"))
    total, size = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = buckets or bucket_count(total, size, bucket_bytes)
    rows = _numbered_copies(rows).withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))

    counts = scratch.written(rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("bucket") / BLOCK).cast("int")), "buckets")
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for every BLOCK buckets
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    heads = counts.join(offsets, "block").select("bucket", "n", (F.col("earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("begin"))
    tasks = max(1, min(buckets, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))))

    kind = rows.schema["record"].dataType
    opened = heads.select("bucket", F.lit(None).cast("long").alias("key"), "begin", F.col("n").alias("rows"), F.lit(None).cast(kind).alias("record"))
    follow = rows.select("bucket", "key", F.lit(None).cast("long").alias("begin"), F.lit(None).cast("long").alias("rows"), "record")
    task = F.floor(F.col("bucket").cast("long") * tasks / buckets).cast("int")  # runs of buckets, so that a later task has later places
    first = F.col("begin").isNull()
    dealt = opened.unionByName(follow).repartitionById(tasks, task).sortWithinPartitions("bucket", first, "key")

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def emit() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t = pa.Table.from_batches(held)
            held.clear()
            bucket, begin, n = (t[c][0].as_py() for c in ("bucket", "begin", "rows"))
            if n != t.num_rows - 1:
                raise RuntimeError(f"bucket {bucket} has {t.num_rows - 1} rows, not {n}: the input changed between passes")
            records = t["record"].combine_chunks()[1:].take(pa.array(fisher_yates(n, seed, bucket)))
            place = begin + np.arange(n)
            out = pa.RecordBatch.from_arrays([records, pa.array(place // shards), pa.array((place % shards).astype(np.int32))], ["record", "slot", "shard"])
            step = max(1, n * OUT_BYTES // max(records.nbytes, 1))
            yield from (out.slice(at, step) for at in range(0, n, step))

        for batch in batches:
            head = np.flatnonzero(batch.column("begin").is_valid().to_numpy(zero_copy_only=False))
            last = 0
            for at in head.tolist():
                if at > last:
                    held.append(batch.slice(last, at - last))
                yield from emit()
                last = at
            if batch.num_rows > last:
                held.append(batch.slice(last))
        yield from emit()

    schema = T.StructType([T.StructField("record", kind), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    out = dealt.select("bucket", "begin", "rows", "record").mapInArrow(shuffle, schema)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def sharded(df: DataFrame, shards: int, seed: int = 42, **options) -> DataFrame:
    """external_shuffle into the shared folder."""
    return external_shuffle(df, shards, scratch.new_path(df.sparkSession, "shards"), seed, **options)
