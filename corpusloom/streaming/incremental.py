"""Streams: incremental files with checkpoints in place of resume lists, and event-time aggregates.

The reference has no event-time operators; these are what its file-by-file
resume logic becomes, and the window functions a user would expect beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process the Parquet files that no earlier run has seen, then stop; the checkpoint remembers them."""
    stream = spark.readStream.schema(schema).parquet(source)
    out = transform(stream) if transform else stream
    query = out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _timed(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark; an event time without a zone is taken as the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by window and type; works on a stream and on a table."""
    marked = _timed(events, late)
    return marked.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user: events no further apart than the gap."""
    marked = _timed(events, late)
    out = marked.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def first_seen(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    """Each key once, within the watermark on a stream."""
    if events.isStreaming:
        return _timed(events, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])
