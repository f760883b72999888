"""Versioned history kept as a table: each run rewrites only the buckets of keys that it has rows of."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.dedup import dedup_exact, keep_most_complete
from ..operators.history import scd2
from ..scratch import stored
from . import commits
from .sinks import BUCKET, key_bucket

#: What scd2() adds to the rows it is given.
TOLD = ("valido_de", "valido_ate", "is_current")


def merge_history(rows: DataFrame, base: str, keys: list[str], version_col: str, run: str | None = None, by_time: bool = False, audit: list[str] = (), skip_suffix: str = "_pncp", buckets: int = 256) -> list[int]:
    """Merges rows into the history at base and returns the buckets that were rewritten.

    Rows may be new versions, late ones (older than versions that are there), repeated ones or other states of a
    version that is there; the table is what it would be if all rows of all runs had come at once. By dates (as
    jobs.versioned) one row a key and date stays, the most complete; by_time (as jobs.load_versions) each one counts.

    The table lies by bucket of its key; the rows of buckets that a run touches are read, joined with the new ones,
    versioned anew and written beside the old ones, and a numbered commit says which folder holds each bucket now. The
    others aren't read. A run that is tried again under its name does nothing; two writers at once don't both succeed.
    """
    spark, now = rows.sparkSession, commits.state(rows.sparkSession, base)
    run = run or uuid.uuid4().hex
    if run in now.runs:
        return []
    buckets = now.info.get("buckets", buckets)
    if now.number and (now.info["keys"] != keys or now.info["version_col"] != version_col):
        raise ValueError(f"the history at {base} is of {now.info['keys']} by {now.info['version_col']}")
    new = stored(rows.withColumn(BUCKET, key_bucket(rows, keys, buckets)), "merged")
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # a number a bucket
    if not touched:
        return []
    if now.number:
        new = history_rows(spark, base, touched, now).drop(*TOLD).unionByName(new)
    one = dedup_exact(new.repartition(*keys), list(audit))
    if not by_time:
        one = keep_most_complete(one, keys, version_col, exclude=[*keys, version_col, BUCKET], skip_suffix=skip_suffix)
    told = scd2(one, keys, version_col, by_time)
    folder = commits.new_folder("history")
    told.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{base}/{folder}")
    held = {**now.info.get("held", {}), **{str(b): folder for b in touched}}
    schema = T.StructType([f for f in told.schema if f.name != BUCKET]).jsonValue()
    commits.commit(spark, base, now, run, sorted(set(held.values())), {"keys": keys, "version_col": version_col, "buckets": buckets, "held": held, "schema": schema})
    return touched


def history_rows(spark: SparkSession, base: str, buckets: list[int] | None = None, now: commits.State | None = None) -> DataFrame:
    """The history at base with its buckets, or the rows of some buckets: only their folders are read."""
    now = now or commits.state(spark, base)
    if not now.number:
        raise ValueError(f"no history at {base}")
    schema = T.StructType.fromJson(now.info["schema"])
    paths = [(int(b), f"{base}/{f}/{BUCKET}={b}") for b, f in now.info["held"].items() if buckets is None or int(b) in set(buckets)]
    if not paths:
        return spark.createDataFrame([], schema.add(BUCKET, T.IntegerType()))
    read = spark.read.schema(schema).parquet(*(p for _, p in paths))
    bucket = F.regexp_extract("_metadata.file_path", rf"/{BUCKET}=(\d+)/", 1).cast("int")
    return read.withColumn(BUCKET, bucket)


def history(spark: SparkSession, base: str) -> DataFrame:
    """The whole history at base."""
    return history_rows(spark, base).drop(BUCKET)
