"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder of this machine where it is unset and executors run in the driver (tests)."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir is unset, and executors of {master} share no folder with the driver")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = tempfile.mkdtemp(prefix="corpusloom-")
    return "file://" + _own[key]


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _late(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session has ended, and with it the way to the folder
        pass


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_late, spark, path)
    return path


def written(df: DataFrame, name: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, so a lost executor costs no recomputation before it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table of written() that nothing reads any more."""
    if path := getattr(df, "_scratch_path", None):
        delete(df.sparkSession, path)
