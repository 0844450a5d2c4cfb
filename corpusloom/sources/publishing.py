"""Publishing in parts that can be interrupted: a ledger says which units are out.

A unit is a part of a table that is published whole: an input file, a source
and language.  A version of a set lies below one root:

    data/<version>/<unit>/*.parquet     what is published
    _ledger/<version>/<unit>.json       one row: unit, output, rows, run; there once the output is
    _ledger/<version>/<unit>.claim      the run that works on the unit now
    _staging/<run>/                     what is being written

A batch of units is written by one ordinary Spark write to the staging folder,
so a unit may be of any size and many tasks write it.  Then each unit's folder
is renamed to its place and its ledger row is renamed into the ledger.  A run
that is killed at any point leaves units with a row, which are whole, and units
without, which the next run writes anew, replacing what may lie there; so no
row is lost or doubled.  Claims keep two runs from doing the same work; they
are made by exclusive creation and expire, but nothing depends on them: if two
runs do write a unit, the later one replaces the earlier.

Renames must be atomic, as they are on HDFS and local file systems; on stores
without renames, a reader is still safe, since load() takes only units that the
ledger has.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import stores

LEDGER = "unit string, output string, rows long, run string"
MOST_UNITS = 1_000_000


class Held(Exception):
    """Units that other runs have claimed."""


class Ledger:
    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        self.folder = f"{self.root}/_ledger/{version}"
        self.fs, _ = stores.hadoop(spark, self.root)

    def _path(self, *parts: str):
        return stores.hadoop(self.spark, "/".join(parts))[1]

    def _file(self, unit: str, kind: str):
        return self._path(self.folder, f"{quote(unit, safe='')}.{kind}")

    def output(self, unit: str) -> str:
        return f"{self.root}/data/{self.version}/{quote(unit, safe='')}"

    def _put(self, path, text: str) -> None:
        out = self.fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _text(self, path) -> str:
        stream = self.fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def rows(self) -> DataFrame:
        """The units that are out."""
        if not self.fs.exists(self._path(self.folder)):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).option("pathGlobFilter", "*.json").json(self.folder)

    def claim(self, unit: str, run: str, lease: float) -> bool:
        """Whether the run has the unit now; a claim older than ``lease`` seconds is taken over, and what its run staged is deleted."""
        path = self._file(unit, "claim")
        if self.fs.exists(path) and time.time() - self.fs.getFileStatus(path).getModificationTime() / 1000 >= lease:
            aside = self._path(self.folder, f"_{quote(unit, safe='')}.{run}")
            if self.fs.rename(path, aside):  # one of several runs succeeds
                old = self._text(aside)
                if old:
                    self.fs.delete(self._path(self.root, "_staging", old), True)
                self.fs.delete(aside, False)
        if not self.fs.createNewFile(path):
            return False
        self._put(path, run)
        return True

    def release(self, units: Iterable[str]) -> None:
        for unit in units:
            self.fs.delete(self._file(unit, "claim"), False)

    def commit(self, unit: str, staged: str | None, rows: int, run: str) -> None:
        """Rename what was staged to its place, then enter it."""
        target = self._path(self.output(unit))
        self.fs.delete(target, True)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self._path(staged), target):
            raise OSError(f"{staged} can't be renamed to {target}")
        draft = self._path(self.folder, f"_{quote(unit, safe='')}.{run}.draft")
        self._put(draft, json.dumps({"unit": unit, "output": self.output(unit), "rows": rows, "run": run}))
        if not self.fs.rename(draft, self._file(unit, "json")):
            raise OSError(f"no ledger row for {unit}")
        self.release([unit])


def publish(df: DataFrame, unit: Column, root: str, version: str, batch: int = 100, lease: float = 6 * 3600, most_batches: int | None = None, strict: bool = False) -> list[str]:
    """Publish the units of df that aren't out yet, ``batch`` at a time; returns those this run has published.

    Only unit names reach the driver, at most MOST_UNITS of them.  Units that another run holds are left to it, or are an error if ``strict``.  Rows whose unit is null are an error, since they would belong nowhere.
    """
    spark = df.sparkSession
    ledger, run = Ledger(spark, root, version), uuid.uuid4().hex
    ledger.fs.mkdirs(ledger._path(ledger.folder))
    rows = df.withColumn("_unit", unit.cast("string"))
    names = rows.select("_unit").distinct().join(ledger.rows().select(F.col("unit").alias("_unit")), "_unit", "left_anti").orderBy("_unit").limit(MOST_UNITS + 1)
    todo = [r["_unit"] for r in names.collect()]
    if len(todo) > MOST_UNITS:
        raise ValueError(f"over {MOST_UNITS} units: choose larger ones")
    if None in todo:
        raise ValueError("rows without a unit")
    done: list[str] = []
    held: list[str] = []
    batches = [todo[i : i + batch] for i in range(0, len(todo), batch)][:most_batches]
    for number, some in enumerate(batches):
        mine = [u for u in some if ledger.claim(u, run, lease)]
        held += sorted(set(some) - set(mine))
        if not mine:
            continue
        staged = f"{ledger.root}/_staging/{run}/{number}"
        try:
            places = spark.createDataFrame(list(enumerate(mine)), "_k int, _unit string")
            part = rows.filter(F.col("_unit").isin(mine)).join(F.broadcast(places), "_unit").drop("_unit")  # at most ``batch`` names
            part.write.partitionBy("_k").parquet(staged)
            count = {r["_k"]: r["n"] for r in spark.read.parquet(staged).groupBy("_k").agg(F.count("*").alias("n")).collect()}  # from footers
            for k, u in enumerate(mine):
                ledger.commit(u, f"{staged}/_k={k}", count[k], run)
                done.append(u)
        finally:
            ledger.release(u for u in mine if u not in done)
            ledger.fs.delete(ledger._path(ledger.root, "_staging", run), True)
    if held and strict:
        raise Held(", ".join(held))
    return done


def versions(spark: SparkSession, root: str) -> list[str]:
    """Versions that have a ledger, the latest last: v1.10 after v1.9."""
    fs, path = stores.hadoop(spark, f"{root.rstrip('/')}/_ledger")
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(found, key=lambda v: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", v)])


def outputs(spark: SparkSession, root: str, names: list[str] | None = None, version: str | None = None) -> list[str]:
    """Folders of the units of a version (the latest unless one is given) whose name is, or begins with, one of ``names`` followed by ``/``, ``.`` or ``-``."""
    version = version or next(reversed(versions(spark, root)), None)
    if version is None or version not in versions(spark, root):
        raise FileNotFoundError(f"no version {version or ''} below {root}")
    rows = Ledger(spark, root, version).rows()
    if names is not None:
        fits = F.lit(False)
        for n in names:
            fits = fits | (F.col("unit") == n) | F.col("unit").rlike("^" + re.escape(n) + "[/.-]")
        rows = rows.filter(fits)
    return [r["output"] for r in rows.select("output").orderBy("output").collect()]


def load(spark: SparkSession, root: str, names: list[str] | None = None, version: str | None = None) -> DataFrame:
    """The published rows of some units; only their files are listed and scanned."""
    found = outputs(spark, root, names, version)
    if not found:
        raise FileNotFoundError(f"no unit {names} below {root}")
    return spark.read.parquet(*found)
