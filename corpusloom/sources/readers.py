"""Readers.  Schemas are stated, not inferred, wherever the format allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WEB_SCHEMA = "raw_content string, doc_id string, meta string, quality_signals string"
META_SCHEMA = "url string, partition string, language string, source_domain string, date_download string, digest string"
SIGNALS_SCHEMA = "map<string, array<array<double>>>"
STATS_SCHEMA = "`time to iterate (sec)` double, `num pages` bigint, `num words` bigint, `num chars` bigint"
TOKEN_STATS_SCHEMA = "total_tokens bigint, total_sequences bigint, min_tokens bigint, max_tokens bigint"


def parquet(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """Parquet files, with their path as a column; ``pattern`` is a glob on file names."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("file_path"))


def cleaned_or_raw(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """The cleaned copy beside a dataset where there is one, unless the raw data is asked for."""
    jvm = spark.sparkContext._jvm
    copy = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "_cleaned")
    there = copy.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(copy)
    return spark.read.parquet(copy.toString() if there and not raw else path)


def paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """Plain text cut at blank lines; a record has no line breaks at its ends, and empty ones don't count."""
    text = spark.read.option("lineSep", "\n\n").text(path).select(F.regexp_replace("value", r"^\n+|\n+$", "").alias("text"), F.col("_metadata.file_path").alias("file_path"))
    return text.filter("text <> ''")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or compressed; rows that don't parse are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document for each file, from a folder and its subfolders, with the file's name."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def padded_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose headers and cells are padded with spaces; empty cells are null."""
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return rows.select(*[F.nullif(F.trim(rows[f"`{c}`"]), F.lit("")).alias(c.strip()) for c in rows.columns])


def typed(value):
    """A cell as an integer where it reads as one, else a double, else text: a struct of the three."""
    value = F.trim(value)
    whole = value.try_cast("long")
    real = F.when(whole.isNull(), value.try_cast("double"))
    return F.struct(whole.alias("whole"), real.alias("real"), F.when(whole.isNull() & real.isNull(), value).alias("text"))


def web_records(spark: SparkSession, docs: DataFrame, signals: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Web documents zipped with their signals by (shard, row), and flagged where their id is listed as a duplicate."""
    out = docs.join(signals, ["shard", "row"]).withColumn("doc_id", F.concat("shard", F.lit("/"), F.col("row").cast("string")))
    if duplicates is None:
        return out.withColumn("is_duplicate", F.lit(False))
    listed = duplicates.select("doc_id").distinct().withColumn("is_duplicate", F.lit(True))
    return out.join(listed, "doc_id", "left").withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(False)))


def repeated(spark: SparkSession, texts: list[str], times: int = 8) -> DataFrame:
    """Texts held in memory, each ``times`` times."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row int, text string")
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy"))


def weight_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(weight, path) pairs of a text ``weight path weight path ...``."""
    words = spark.read.option("wholetext", True).text(path).select(F.split(F.trim("value"), r"\s+").alias("w"))
    pairs = words.select(F.posexplode(F.transform(F.sequence(F.lit(0), (F.size("w") / 2 - 1).cast("int")), lambda i: F.struct(F.get("w", (2 * i).cast("int")).cast("double").alias("weight"), F.get("w", (2 * i + 1).cast("int")).alias("path")))).alias("at", "p"))
    return pairs.select("at", "p.*")
