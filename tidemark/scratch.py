"""Where jobs keep what they write and read again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_made: dict[str, list[str]] = {}  # by application: paths, and tables as "table:<name>"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Without that setting a local session takes a temporary folder; on a cluster it is an error, as executors
    can't see the driver's folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_folder.setdefault(app, tempfile.mkdtemp(prefix="tidemark-"))
    path = f"{base.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(app, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: its lineage ends there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_table(spark: SparkSession, name: str) -> str:
    """The name of a new scratch table."""
    table = f"tidemark_{name}_{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(f"table:{table}")
    return table


def clear_scratch(spark: SparkSession) -> int:
    """Removes all scratch paths and tables of this application; returns how many there were.

    Results that haven't been written yet read them, so this is for the end of a job.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    for m in made:
        if m.startswith("table:"):
            spark.sql(f"DROP TABLE IF EXISTS {m.removeprefix('table:')} PURGE")
        else:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(m)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(made)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast if it has at most so many rows; else joins shuffle both sides."""
    return df.hint("broadcast") if df.limit(rows + 1).count() <= rows else df
