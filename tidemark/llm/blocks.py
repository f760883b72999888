"""Documents in blocks of a few MB, and exchanges between blocks and shards of a key space.

Many corpus questions ask of each key of a document (a hashed word, an anchor of a long match) what all other
documents say of it. A block sends each of its distinct keys once, so a key that a third of all documents
bear costs one entry a block; shards of the key space answer every block in the order it asked in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..scratch import shared_table
from .common import give_back, small_batches

#: Text bytes of a block (one longer document is a block alone) and of what a shard answers for.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 2 << 20


def packed(docs: DataFrame, text_col: str = "text", name: str = "blocks") -> DataFrame:
    """docs as a bucketed table of blocks: block, size (text bytes), data (an Arrow stream of the rows).

    It is bucketed by block, so joining answers to it doesn't move text. Rows keep all their columns.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            give_back()
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["size", "data"])

        for batch in batches:
            lengths = batch.column(text_col).cast(pa.large_string()).fill_null("")
            ends = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1]
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + BLOCK_BYTES - size, "right")) - 1)
                held.append(batch.slice(a, b - a))
                size += int(ends[b] - ends[a])
                if size >= BLOCK_BYTES or (b < batch.num_rows and held):
                    yield block()
                    held, size = [], 0
                a = b
        if held:
            yield block()

    table = shared_table(spark, name)
    rows = docs.mapInArrow(made, "size long, data binary").select(F.monotonically_increasing_id().alias("block"), "size", "data")
    n = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.write.bucketBy(n, "block").option("compression", "none").saveAsTable(table)
    return spark.table(table)


def opened(data: pa.Scalar) -> pa.Table:
    """The rows of a block."""
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def shard_count(blocks: DataFrame) -> int:
    total = blocks.agg(F.sum("size")).first()[0] or 0
    return max(12, -(-total // SHARD_BYTES))


def asked(blocks: DataFrame, ask: Callable[[pa.Table, list], Iterator[tuple]], fields: str, answers: tuple[DataFrame, ...] = ()) -> DataFrame:
    """What blocks send to shards: shard, block and fields, from ask(rows, earlier answers by shard)."""
    schema = f"shard int, block long, {fields}"
    arrow, n_answers = to_arrow_schema(StructType.fromDDL(schema)), len(answers)

    def made(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.column("block")[k].as_py()
                told = [earlier(batch.column(f"answer{i}")[k]) for i in range(n_answers)]
                rows = list(ask(opened(batch.column("data")[k]), told))
                give_back()
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array([block] * len(rows), pa.int64()), *(pa.array(c, arrow.field(i + 2).type) for i, c in enumerate(cols[1:]))], schema=arrow)

    return joined(blocks, answers).mapInArrow(made, schema)


def joined(blocks: DataFrame, answers: tuple[DataFrame, ...]) -> DataFrame:
    """blocks with the answers to each, as an array ordered by shard."""
    out = blocks
    for i, a in enumerate(answers):
        by_block = a.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "reply"))).alias(f"answer{i}"))
        out = out.join(by_block.hint("shuffle_hash"), "block", "left")
    return out


def earlier(answer: pa.Scalar) -> dict[int, bytes]:
    """Replies by shard."""
    return {r["shard"]: r["reply"] for r in answer.as_py() or ()}


def answered(questions: DataFrame, reply: Callable[[pa.Table], list[bytes]]) -> DataFrame:
    """shard, block, reply: reply(all questions to one shard) gives the bytes for each of them."""

    def made(table: pa.Table) -> pa.Table:
        out = reply(table)
        give_back()
        return pa.table({"shard": table.column("shard"), "block": table.column("block"), "reply": pa.array(out, pa.binary())})

    return questions.groupBy("shard").applyInArrow(made, "shard int, block long, reply binary")
