"""Rewrite of files whose schemas drifted apart (operator 12).

Rows get exact ranks in the order of crc32 of their id, then id, without a
global sort: a fixed histogram over the high bits of the crc32 is summed up
(exclusive prefix sums over at most 2^BITS rows), and a row's rank is what lies
before its bucket plus its row_number inside.  Where a bucket is heavy, because
an id repeats, it is cut into segments that follow the same order: rows below,
at and above the heavy id; a heavy id's rows by the hash of the whole row; and
heavy equal rows by the place they were read from.  So ties between rows of one
id go by the hash of the whole row, and no window holds a hot group.

Ranks are dealt in order to files.  ``write_files`` writes each, sorted, by one
streaming task (groups arrive in batches, in order of rank, and are never held
whole), under a schema of its own; Parquet field ids say which column is which.
``evolve_files`` reads each file in batches, matches columns by field id, casts
them, fills those that are missing, and writes the target schema; a file that
has it already isn't touched.

Files appear by rename, from a work folder beside them, so a task that is run
again, or twice, leaves one whole file; originals are deleted only when every
rewrite is there.  Either run can be repeated after any loss.

Values: null ids come first (their crc32 counts as 0); nulls stay nulls; ids
that repeat, and whole rows that do, keep their numbers of rows; an empty table
gives no file and an empty result; further columns of the table are left out,
and a missing one is an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.sources import scratch

BITS = 16
HEAVY_TIMES, HEAVY_LEAST = 8, 2048
SPLITS = 64
ROW_GROUP = 1 << 17
TASK_ROWS = 100_000


class Field(NamedTuple):
    """A column of a file: Parquet field id, name, Arrow type."""

    id: int
    name: str
    type: str

    def arrow(self) -> pa.Field:
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "float": pa.float32(), "timestamp": pa.timestamp("us")}
        return pa.field(self.name, kinds[self.type], True, {"PARQUET:field_id": str(self.id)})


def arrow_schema(fields: list[Field]) -> pa.Schema:
    return pa.schema([f.arrow() for f in fields])


def _heavy(rows: DataFrame, by: list[str], limit: float) -> DataFrame:
    """Keys with over ``limit`` rows, as (bucket, heavy: sorted array of their structs); under 2^BITS of them, since each holds more than a bucket's share."""
    keys = rows.groupBy("_bucket", *by).agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return scratch.written(keys.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct(*by))).alias("heavy")), "heavy")


def _against(rows: DataFrame, heavy: DataFrame, by: list[str], place: str) -> DataFrame:
    """rows with ``place``: 2 * (heavy keys below the row's) + whether its key is one."""
    key = F.struct(*by)
    below = F.size(F.filter("heavy", lambda x: x < key))
    upto = F.size(F.filter("heavy", lambda x: x <= key))
    return rows.join(F.broadcast(heavy), "_bucket", "left").withColumn(place, F.when(F.col("heavy").isNull(), 0).otherwise(below + upto)).drop("heavy")


def exact_ranks(df: DataFrame, id_col: str, bits: int = BITS) -> tuple[DataFrame, int]:
    """df with ``_rank`` (long, from 0) in the order of unsigned crc32 of the decimal id, then id; and the number of rows."""
    crc = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0).cast("long"))
    rows = df.withColumn("_crc", crc).withColumn("_bucket", F.shiftrightunsigned("_crc", 32 - bits).cast("int"))
    rows = rows.withColumn("_id", F.col(id_col))
    histogram = scratch.written(rows.groupBy("_bucket").agg(F.count("*").alias("n")), "histogram")
    total, most = histogram.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    limit = max(HEAVY_LEAST, HEAVY_TIMES * total / (1 << bits))
    segment = ["_bucket"]
    rows = rows.withColumn("_tie", F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in df.columns]))
    if most > limit:
        rows = scratch.written(rows.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()), "ranked")
        parts = 1 + rows.agg(F.max("_part")).first()[0]
        hot = rows.join(F.broadcast(histogram.filter(F.col("n") > limit).select("_bucket")), "_bucket", "left_semi")
        rows = _against(rows, _heavy(hot, ["_crc", "_id"], limit / 2), ["_crc", "_id"], "_s1")
        rows = rows.withColumn("_s2", F.when(F.col("_s1") % 2 == 1, F.shiftright("_tie", 58)).otherwise(0))
        rows = _against(rows, _heavy(hot, ["_crc", "_id", "_tie"], limit / 2), ["_crc", "_id", "_tie"], "_s3")
        rows = rows.withColumn("_s4", F.when(F.col("_s3") % 2 == 1, F.floor(F.col("_part") * SPLITS / F.lit(parts))).otherwise(0).cast("int"))
        segment += ["_s1", "_s2", "_s3", "_s4"]
        histogram = scratch.written(rows.groupBy(*segment).agg(F.count("*").alias("n")), "histogram")
    earlier = Window.orderBy(*segment).rowsBetween(Window.unboundedPreceding, -1)  # one row a segment: a fixed number
    begins = histogram.select(*segment, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy(*segment).orderBy("_crc", "_id", "_tie", *(["_seq"] if len(segment) > 1 else []))
    rows = rows.withColumn("_number", F.row_number().over(inside)).join(F.broadcast(begins), segment)
    return rows.select(*df.columns, (F.col("_begin") + F.col("_number") - 1).alias("_rank")), total


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


class _Writer:
    """A Parquet file that appears at ``path`` when it is whole."""

    def __init__(self, path: str, work: str, schema: pa.Schema):
        self.fs, self.path = _store(path)
        self.schema, self.held, self.rows = schema, [], 0
        self.fs.create_dir(self.path.rpartition("/")[0])
        folder = _store(work)[1]
        self.fs.create_dir(folder)
        self.draft = f"{folder}/{uuid.uuid4().hex}.parquet"
        self.out = pq.ParquetWriter(self.draft, schema, filesystem=self.fs)

    def add(self, columns: list[pa.Array]) -> None:
        self.held.append(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.rows += len(columns[0])
        if self.rows >= ROW_GROUP:
            self._put()

    def _put(self) -> None:
        if self.held:
            self.out.write_table(pa.Table.from_batches(self.held))
            self.held, self.rows = [], 0

    def close(self) -> None:
        self._put()
        self.out.close()
        self.fs.move(self.draft, self.path)


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    return column if column.type == kind else column.cast(kind, safe=False)


def write_files(ranked: DataFrame, folder: str, fields: list[Field], per_file: int, version: Callable[[int], int], drifted: Callable[[list[Field], int], list[Field]]) -> DataFrame:
    """Write rows (fields' names, _rank) in order of rank, ``per_file`` to a file, each file under its version's schema; (file_no, version, n_rows, start_columns, path)."""
    dealt = ranked.withColumn("file_no", F.floor(F.col("_rank") / per_file).cast("int"))
    dealt = dealt.repartition("file_no").sortWithinPartitions("file_no", "_rank")  # the grouping needs no other sort

    def write(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = key[0].as_py()
        own = drifted(fields, version(no))
        names = {f.id: f.name for f in fields}
        path = f"{folder}/data/{no:05d}.parquet"
        out, n = _Writer(path, f"{folder}/work", arrow_schema(own)), 0
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            if len(rank) and (rank != no * per_file + n + np.arange(len(rank))).any():
                raise RuntimeError(f"rows of file {no} came out of order")
            out.add([_cast(batch.column(names[f.id]), f.arrow().type) for f in own])
            n += len(rank)
        out.close()
        yield pa.RecordBatch.from_pydict({"file_no": pa.array([no], pa.int32()), "version": pa.array([version(no)], pa.int32()), "n_rows": [n], "start_columns": [",".join(f.name for f in own)], "path": [path]})

    return dealt.groupBy("file_no").applyInArrow(write, "file_no int, version int, n_rows long, start_columns string, path string")


class Digest:
    """SHA-256 of values joined by a mark, fed in batches."""

    def __init__(self, mark: bytes):
        self.sha, self.mark, self.any = hashlib.sha256(), mark, False

    def add(self, values: pa.Array) -> None:
        if len(values):
            self.sha.update((self.mark if self.any else b"") + self.mark.join(values.cast(pa.binary()).to_pylist()))
            self.any = True


def shown(column: pa.Array) -> pa.Array:
    """A column as strings, null as ``?``: times as microseconds, fractions in whole 2^-20ths, rounded down."""
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us")).cast(pa.int64())
    if pa.types.is_floating(column.type):
        x = column.cast(pa.float64())
        whole = pc.floor(pc.multiply(x, 1048576.0))
        inside = pc.and_(pc.is_finite(whole), pc.less(pc.abs(whole), 2.0**62))
        if pc.all(pc.fill_null(inside, True)).as_py() is False:  # beyond 64 bits, or not finite
            return pa.array(["?" if v is None else str(int(v)) if np.isfinite(v) else str(v) for v in whole.to_pylist()], pa.string())
        column = whole.cast(pa.int64())
    return column.cast(pa.string()).fill_null("?")


def evolve_files(files: DataFrame, folder: str, fields: list[Field], fill: dict[int, object], id_field: int = 1, tasks: int = 500) -> DataFrame:
    """files (file_no, version, start_columns, path) with each file brought to ``fields``, dealt to ``tasks`` tasks.

    Columns are matched by field id and missing ones filled from ``fill``.  A
    file that has the schema already stays as it is; another one's rewrite
    appears beside it.  (file_no, version, n_rows, n_nulls, ids_sha256,
    rows_sha256, start_columns, columns, path, rewritten).
    """
    target = arrow_schema(fields)

    def rewrite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            fs, at = _store(row["path"])
            source = pq.ParquetFile(fs.open_input_file(at))
            have = {int(f.metadata[b"PARQUET:field_id"]): i for i, f in enumerate(source.schema_arrow)}
            same = [(f.name, f.type, f.metadata[b"PARQUET:field_id"]) for f in source.schema_arrow] == [(f.name, f.type, f.metadata[b"PARQUET:field_id"]) for f in target]
            path = row["path"] if same else row["path"].removesuffix(".parquet") + "-evolved.parquet"
            out = None if same else _Writer(path, f"{folder}/work", target)
            ids, rows, n, nulls = Digest(b","), Digest(b"\n"), 0, 0
            for batch in source.iter_batches(1 << 16):
                columns = [_cast(batch.column(have[f.id]), t.type) if f.id in have else pa.array([fill[f.id]] * batch.num_rows, t.type) for f, t in zip(fields, target, strict=True)]
                if out:
                    out.add(columns)
                text = {f.id: shown(c) for f, c in zip(fields, columns, strict=True)}
                ids.add(text[id_field])
                rows.add(pc.binary_join_element_wise(*text.values(), "|"))
                n, nulls = n + batch.num_rows, nulls + sum(c.null_count for c in columns)
            source.close()
            if out:
                out.close()
            yield pa.RecordBatch.from_pydict({"file_no": pa.array([row["file_no"]], pa.int32()), "version": pa.array([row["version"]], pa.int32()), "n_rows": [n], "n_nulls": [nulls], "ids_sha256": [ids.sha.hexdigest()], "rows_sha256": [rows.sha.hexdigest()], "start_columns": [row["start_columns"]], "columns": [",".join(target.names)], "path": [path], "rewritten": [not same]})

    result = "file_no int, version int, n_rows long, n_nulls long, ids_sha256 string, rows_sha256 string, start_columns string, columns string, path string, rewritten boolean"
    dealt = files.select("file_no", "version", "start_columns", "path").repartition(tasks, "file_no")  # a number given: else few rows would go to one task, with all files
    return dealt.groupBy("file_no").applyInArrow(rewrite, result)


def delete_replaced(files: DataFrame, done: DataFrame, folder: str) -> None:
    """Delete the originals of files whose rewrite is there, and the work folder."""
    old = files.select("file_no", F.col("path").alias("old")).join(done.filter("rewritten").select("file_no"), "file_no")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("old").to_pylist():
                fs, at = _store(path)
                if fs.get_file_info(at).type != pa.fs.FileType.NotFound:
                    fs.delete_file(at)
        yield from ()

    old.mapInArrow(delete, "n long").write.format("noop").mode("overwrite").save()
    scratch.delete(files.sparkSession, f"{folder}/work")


#: The evolved schema of clients, what fills its missing columns, and the drift of each version bit.
CLIENTS = [Field(1, "client_id", "long"), Field(2, "master_id", "long"), Field(3, "source", "string"), Field(4, "updated_at", "timestamp"), Field(5, "name", "string"), Field(6, "email", "string"), Field(7, "city", "string"), Field(8, "nation_id", "long"), Field(9, "segment", "string"), Field(10, "balance", "double")]
FILL = {8: -1, 3: "none"}
SWAPPED, REVERSED, MISSING, NARROWED = 1, 2, 4, 8


def client_version(file_no: int) -> int:
    v = zlib.crc32(f"42:{file_no}".encode()) % 24
    return v if v <= 15 else 0


def drifted_clients(fields: list[Field], version: int) -> list[Field]:
    """The evolved schema as an older writer would have had it; ids stay with their data."""
    out = list(fields)
    if version & SWAPPED:
        other = {"name": "email", "email": "name"}
        out = [f._replace(name=other.get(f.name, f.name)) for f in out]
    if version & REVERSED:
        out = out[:1] + out[:0:-1]
    if version & MISSING:
        out = [f for f in out if f.id not in FILL]
    if version & NARROWED:
        narrow = {10: "float", 8: "int"}
        out = [f._replace(type=narrow.get(f.id, f.type)) for f in out]
    return out


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark understands it, for libraries that would take one without a scheme as local."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    full = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return f"file://{full[5:]}" if full.startswith("file:/") and not full.startswith("file://") else full


def rewrite_clients(df: DataFrame, files: int = 500) -> DataFrame:
    """Deal df's rows to about ``files`` drifted files in a new folder of the shared folder, then rewrite these to one schema; one row a final file.

    The folder stays: its ``data`` holds the final files and nothing else.
    """
    folder = f"{_qualified(df.sparkSession, scratch.shared_dir(df.sparkSession))}/rewrite-{uuid.uuid4().hex}"
    ranked, total = exact_ranks(df.select(*[f.name for f in CLIENTS]), "client_id")
    started = scratch.written(write_files(ranked, folder, CLIENTS, 1 + total // files, client_version, drifted_clients), "started")
    tasks = min(files, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_ROWS))
    done = scratch.written(evolve_files(started, folder, CLIENTS, FILL, tasks=max(1, tasks)), "evolved")
    delete_replaced(started, done, folder)
    return done
