"""Folders of many files, each of which keeps its own name, rows and output.

Files are listed by Spark, sifted by rules on their paths, numbered in the order
of their paths, and dealt to tasks by size: a task takes files one after the
other until it has ``task_bytes``, so that small files share a task, and the
number of tasks follows the bytes and not the files.  A file is read whole by
one task, in batches, so that its rows have places and its output is one file;
larger ones belong to ``spark.read``, which splits them.

The listing may have any number of files: it is neither collected nor put
through one task.  Files of no bytes are not listed, and a folder without files
that are kept gives no rows.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import ordered
from corpusloom.sources import corpora, scratch, stores

TASK_BYTES = 128 << 20
#: What opening a file costs, in bytes read in the same time.
OPENING = 256 << 10
BATCH_BYTES = 4 << 20
LINES = "file string, at long, row long, text string"


@dataclass(frozen=True)
class Rule:
    """Files whose path matches ``where`` (a regular expression, in any case) must match ``only`` too, and not match ``skip``."""

    where: str
    only: str | None = None
    skip: str | None = None

    def keeps(self, path: Column) -> Column:
        fits = F.lit(True)
        if self.only is not None:
            fits = fits & path.rlike(f"(?i){self.only}")
        if self.skip is not None:
            fits = fits & ~path.rlike(f"(?i){self.skip}")
        return ~path.rlike(f"(?i){self.where}") | fits


#: Of web crawls only the last years, and parts that are counted elsewhere.
SKIPS = [Rule("RedPajama", only="2023"), Rule("FineWebEdu", only="2024"), Rule("subscene", skip="."), Rule("peS2o", skip="train|s2orc-validation|s2ag-validation"), Rule("CroissantAligned", skip="augment")]


def listing(spark: SparkSession, root: str, pattern: str = "*", rules: Sequence[Rule] = ()) -> DataFrame:
    """(path below the root, bytes) of the files in a folder and its subfolders that match a glob on their names and all rules; only their heads are looked at."""
    root = stores.qualified(spark, root.rstrip("/"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    start = F.lit(root.split("://", 1)[-1] + "/")
    below = F.substring(whole, F.locate(root.split("://", 1)[-1] + "/", whole) + F.length(start), F.length(whole))
    out = found.select(below.alias("path"), F.col("_metadata.file_size").alias("bytes"))
    for rule in rules:
        out = out.filter(rule.keeps(F.col("path")))
    return out


def numbered(files: DataFrame) -> DataFrame:
    """Files with ``at``, their place from 0 in the order of paths: ranges of paths are counted, then numbered each on its own."""
    spark = files.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = scratch.written(files.repartitionByRange(parts, "path").withColumn("_part", F.spark_partition_id()), "files")
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("_n"))  # one row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("path")) - 1
    return ranges.join(F.broadcast(before), "_part").withColumn("at", place).drop("_part", "_before")


def dealt(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Numbered files with the ``task`` that takes each: as many as have ``task_bytes`` together, and at most one that crosses it."""
    cost = F.col("bytes") + OPENING
    run = ordered.with_running(files, "at", cost, "_run")
    return run.withColumn("task", F.floor((F.col("_run") - cost) / task_bytes).cast("int")).drop("_run")


def _field(line: str, key: str) -> str | None:
    """A text of a JSON object; null for a line that is none, or has no such text."""
    try:
        value = json.loads(line)
    except json.JSONDecodeError:
        return None
    text = value.get(key) if isinstance(value, dict) else None
    return text if isinstance(text, str) else None


def _texts(root: str, name: str, key: str) -> Iterator[str | None]:
    """Texts of one file: a Parquet column, a field of JSON lines, or, of any other file, its lines."""
    fs, base = stores.store(root)  # names below it may hold what a URI may not
    path = f"{base}/{name}"
    if path.endswith(".parquet"):
        with fs.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=1024, columns=[key]):
                yield from batch.column(0).cast(pa.string()).to_pylist()
        return
    as_json = path.removesuffix(".gz").endswith((".json", ".jsonl"))
    with fs.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as raw, io.TextIOWrapper(raw, "utf-8", newline="\n") as f:
        for line in f:
            yield _field(line, key) if as_json else line.removesuffix("\n")


def read(files: DataFrame, root: str, key: str = "text", task_bytes: int = TASK_BYTES) -> DataFrame:
    """(file, at, row, text) of all files of a listing: the file's path, its place, and the row's place in it.  A broken line keeps its place, without a text."""
    spark = files.sparkSession
    root = stores.qualified(spark, root.rstrip("/"))
    tasks = scratch.written(dealt(numbered(files), task_bytes), "tasks")
    most = tasks.agg(F.coalesce(F.max("task"), F.lit(0)).alias("task")).first().task + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for f in batch.to_pylist():
                for row, text in enumerate(_texts(root, f["path"], key)):
                    held.append((f["path"], f["at"], row, text))
                    size += 64 + len(text or "")
                    if size >= BATCH_BYTES:
                        yield _batch(held)
                        held, size = [], 0
        if held:
            yield _batch(held)

    return tasks.repartitionById(most, F.col("task")).select("path", "at").mapInArrow(run, LINES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in LINES.split(", ")])


def frames(files: DataFrame, root: str, name: str, recipe: corpora.Recipe | None = None, task_bytes: int = TASK_BYTES, **options) -> DataFrame:
    """The rows of read() with the name of their file's frame, ``name--0007``, each under a recipe.

    A budget or a sample is of a whole dataset and means something else for one
    of its files, so both are refused.
    """
    refused = [k for k, v in options.items() if k in ("max_docs", "max_chars", "max_words", "invert") and v or k == "rate" and v != 1]
    if refused:
        raise ValueError(f"files can't be taken one by one under {', '.join(sorted(refused))}")
    rows = read(files, root, (recipe or corpora.Recipe()).key, task_bytes).withColumn("frame", F.format_string(f"{name.replace('%', '%%')}--%04d", "at"))
    return corpora.load(rows, recipe.with_options(key="text"), **options) if recipe else rows


def write_each(rows: DataFrame, path: str) -> None:
    """One folder a frame below ``path``, with one file, its rows in order: those of a file already lie in one task, so nothing is shuffled."""
    rows.sortWithinPartitions("frame", "row").write.partitionBy("frame").parquet(path)
