"""Files beside Spark's own readers and writers: paths as every node understands them, and streams from any store that PyArrow knows."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path, for the driver."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark gives it; libraries would take one without as local."""
    fs, where = hadoop(spark, path)
    full = fs.makeQualified(where).toString()
    return f"file://{full[5:]}" if full.startswith("file:/") and not full.startswith("file://") else full


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """(PyArrow file system, path in it), for executors."""
    return pafs.FileSystem.from_uri(uri)


class Draft:
    """A file that appears under its name only when it is whole; a task that runs again replaces it."""

    def __init__(self, uri: str):
        self.fs, self.path = store(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder)
        self.draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.file = self.fs.open_output_stream(self.draft, compression=None)

    def commit(self) -> None:
        self.file.close()
        self.fs.move(self.draft, self.path)
