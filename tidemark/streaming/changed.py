"""Changed objects in a stream: the last hash of each key is state, so a file that changes under its name is seen."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.changes import CHANGED, NEW, SAME
from ..sources.scans import file_metrics
from ..sources.sinks import append_once

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastHash(StatefulProcessor):
    """Holds each key's last hash, without an end, and tells of each observation whether the key is new, changed or the same."""

    def __init__(self, keys: list[str], hash_col: str, time_col: str):
        self.keys, self.hash_col, self.time_col = keys, hash_col, time_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("hash", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  the interface's names
        known = self.last.get()[0] if self.last.exists() else None
        seen = pd.concat(rows).sort_values([self.time_col, self.hash_col], kind="stable")
        status = []
        for now in seen[self.hash_col]:
            status.append(NEW if known is None else SAME if now == known else CHANGED)
            known = now
        self.last.update((known,))
        yield seen.assign(status=status)[[*self.keys, self.hash_col, self.time_col, "status"]]

    def close(self) -> None:
        pass


def observe(spark: SparkSession, files: str, observations: str, seen_at: str) -> None:
    """One look at the files of a pattern: path, hash and the time of the look, as a new file of observations."""
    told = file_metrics(spark, files).select("path", "hash_sha256", F.lit(seen_at).alias("visto_em"))
    told.write.mode("append").parquet(observations)


def hash_changes(observed: DataFrame, keys: list[str], hash_col: str = "hash_sha256", time_col: str = "visto_em") -> DataFrame:
    """keys, hash, time and status of each observation of a stream: what manifest_diff tells of it and the one before.

    Observations of a key in one batch are taken in the order of time_col; ones without a hash are left out, as an
    object that isn't there keeps its last hash. State is by key, in RocksDB; the stream must be started by changed().
    """
    schema = T.StructType([*(observed.schema[c] for c in [*keys, hash_col, time_col]), T.StructField("status", T.StringType())])
    rows = observed.where(F.col(hash_col).isNotNull()).select(*keys, hash_col, time_col)
    return rows.groupBy(*keys).transformWithStateInPandas(LastHash(keys, hash_col, time_col), schema, "append", "none")


def changed(spark: SparkSession, observations: str, schema: T.StructType | str, target: str, checkpoint: str, keys: list[str], **columns) -> int:
    """Takes in what is new in a folder of observations and appends what each one says to target; returns how many
    batches ran. A batch that runs again after a failure is appended once, by its number."""
    done: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(batch, target, f"batch-{batch_id}")
        done.append(batch_id)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKS)  # a query keeps the settings that it was started under
    try:
        told = hash_changes(spark.readStream.schema(schema).parquet(observations), keys, **columns)
        query = told.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)
    query.awaitTermination()
    return len(done)
