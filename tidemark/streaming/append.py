"""Micro-batch append of drops whose paths never change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.sinks import append_once


def append_new_files(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
    """Appends what new Parquet files in source hold, once; returns how many batches ran.

    Each batch goes to its own folder batch=<id>, overwritten if the batch runs again after a failure, so no
    row is appended twice. A changed file under an old name isn't seen: manifest_diff is for those.
    """
    done: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        done.append(batch_id)

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def late_counts(events: DataFrame, time_col: str, window: str, delay: str, *keys: str) -> DataFrame:
    """Counts of keys in event-time windows of a stream (or table), closed once delay has passed."""
    out = events.withWatermark(time_col, delay) if events.isStreaming else events
    return out.groupBy(F.window(time_col, window), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def closed_windows(spark: SparkSession, source: str, schema: T.StructType | str, target: str, checkpoint: str, time_col: str, window: str, delay: str, *keys: str, files_at_once: int = 1000) -> int:
    """Counts of keys in event-time windows of a folder's new files, appended to target once a window is closed, which
    is when an event later than its end by delay has come; returns how many rows came after their window had closed
    and so count nowhere."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    counts = late_counts(events, time_col, window, delay, *keys)
    query = counts.writeStream.foreachBatch(lambda batch, n: append_once(batch, target, f"batch-{n}") and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
