"""Spark sessions, and the library's code on executors."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Bytes of rows after which a batch for a Python function ends, as it does after 10,000 rows; a function may hold many times as much, and each core has one.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that results here assume: UTC and adaptive plans."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that Python functions find it wherever the driver was started; and end Arrow batches by their bytes, where the session has no bound of its own."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    key = spark.sparkContext.applicationId
    if key in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-code-")
    atexit.register(shutil.rmtree, folder, True)
    path = f"{folder}/corpusloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(path)
    _shipped.add(key)
