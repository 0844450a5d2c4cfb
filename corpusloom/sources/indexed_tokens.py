"""Flat token files: ``.bin`` holds ids one after the other, ``.idx`` the lengths, offsets and document bounds.

The index begins with the nine bytes MMIDIDX, two NULs, then version (8 bytes),
element code (1 byte: 4 for int32, 8 for uint16), the number of sequences and
of document bounds (8 bytes each), int32 lengths, int64 byte offsets and int64
bounds, all little-endian.  A sink task writes one pair of files for its
partition; a source task reads one pair.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

MAGIC = b"MMIDIDX\x00\x00"
KINDS = {4: np.dtype("<i4"), 8: np.dtype("<u2")}


def write_pair(prefix: str, docs: Iterator[list[int]], code: int = 4) -> int:
    """Write documents to prefix.bin and prefix.idx; the number written."""
    lengths: list[int] = []
    with open(prefix + ".bin", "wb") as f:
        for tokens in docs:
            f.write(np.asarray(tokens, KINDS[code]).tobytes())
            lengths.append(len(tokens))
    sizes = np.asarray(lengths, "<i4")
    offsets = (np.cumsum(sizes, dtype="<i8") - sizes) * KINDS[code].itemsize
    with open(prefix + ".idx", "wb") as f:
        f.write(MAGIC + struct.pack("<QBQQ", 1, code, len(sizes), len(sizes) + 1))
        f.write(sizes.tobytes() + offsets.astype("<i8").tobytes() + np.arange(len(sizes) + 1, dtype="<i8").tobytes())
    return len(lengths)


def read_pair(prefix: str) -> Iterator[tuple[int, list[int]]]:
    """(position, tokens) of each sequence."""
    with open(prefix + ".idx", "rb") as f:
        if f.read(9) != MAGIC:
            raise ValueError(f"{prefix}.idx is no token index")
        _, code, n, _ = struct.unpack("<QBQQ", f.read(25))
        sizes = np.frombuffer(f.read(4 * n), "<i4")
        offsets = np.frombuffer(f.read(8 * n), "<i8")
    kind = KINDS[code]
    with open(prefix + ".bin", "rb") as f:
        for i, (size, at) in enumerate(zip(sizes.tolist(), offsets.tolist(), strict=True)):
            f.seek(at)
            yield i, np.frombuffer(f.read(size * kind.itemsize), kind).tolist()


class _File(InputPartition):
    def __init__(self, prefix: str):
        self.prefix = prefix


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        found = sorted(os.path.join(d, f[:-4]) for d, _, files in os.walk(self.path) for f in files if f.endswith(".idx"))
        return [_File(p) for p in found]

    def read(self, partition):
        if partition is not None:
            for i, tokens in read_pair(partition.prefix):
                yield os.path.basename(partition.prefix), i, tokens


class _Done(WriterCommitMessage):
    def __init__(self, prefix: str):
        self.prefix = prefix


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows):
        import uuid

        os.makedirs(self.path, exist_ok=True)
        prefix = os.path.join(self.path, f"._{uuid.uuid4().hex}")
        write_pair(prefix, (list(r.tokens) for r in rows))
        return _Done(prefix)

    def commit(self, messages):
        for i, m in enumerate(m for m in messages if m is not None):
            for end in (".bin", ".idx"):
                os.replace(m.prefix + end, os.path.join(self.path, f"part-{i:05d}{end}"))

    def abort(self, messages):
        for m in messages:
            if m is not None:
                for end in (".bin", ".idx"):
                    os.remove(m.prefix + end)


class IndexedTokens(DataSource):
    """format("indexed_tokens"): rows (file, position, tokens); the path must be a file system that all nodes mount."""

    @classmethod
    def name(cls):
        return "indexed_tokens"

    def schema(self):
        return "file string, position long, tokens array<int>"

    def reader(self, schema):
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IndexedTokens)


def write(df: DataFrame, path: str) -> None:
    """Write the ``tokens`` of a table."""
    from pyspark.sql import functions as F

    register(df.sparkSession)
    rows = df.select(F.lit("").alias("file"), F.lit(0).cast("long").alias("position"), "tokens")
    rows.write.format("indexed_tokens").option("path", path).mode("append").save()


def read(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("indexed_tokens").option("path", path).load()
