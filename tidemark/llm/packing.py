"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..scratch import small
from .common import SMALL_SIDE, ChunkCache, give_back, small_batches, stored

#: Documents that one task ranks within their sizes.
ROWS_PER_TASK = 50_000

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_arrow_pieces = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

#: Distinct chunks that a worker keeps the ids of, some 200 bytes each.
CHUNKS = 250_000

_encoders: dict[tuple[str, int], ChunkCache] = {}


def byte_level_encoder(path: str, chunks: int = CHUNKS) -> ChunkCache:
    """Ids of texts under a byte-level BPE of the tokenizers library.

    Such a tokenizer never joins letters or numbers with other marks (an apostrophe before letters aside), nor
    anything across the start of a white-space run. Chunks are cut there and each distinct one is encoded once;
    those that start with a space are encoded many at a time, and the bytes of their tokens part them again.
    Added tokens in a text get their own ids, as the library does by default: each is a chunk of its own, and
    what lies between them is cut as a text. With added tokens that take white space or need whole words,
    texts are encoded uncut.
    """
    if (path, chunks) not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            n_bytes[i] = len(token)  # a character stands for a byte

        def encode_many(chunks: list[str]) -> list[bytes]:
            out = dict.fromkeys(chunks, b"")
            spaced = [c for c in chunks if c[0] == " " and not c.isspace()]
            groups = [spaced[a : a + 2048] for a in range(0, len(spaced), 2048)]
            for part, e in zip(groups, tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
                flat = np.array(e.ids, "<u4")
                starts = np.cumsum([0] + [len(c.encode()) for c in part])
                first = np.searchsorted(np.concatenate([[0], np.cumsum(n_bytes[flat])]), starts).tolist()
                raw = flat.tobytes()
                out.update((c, raw[4 * first[i] : 4 * first[i + 1]]) for i, c in enumerate(part))
            rest = [c for c in chunks if not out[c]]
            out.update((c, np.array(e.ids, "<u4").tobytes()) for c, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True))
            return [out[c] for c in chunks]

        words = re.compile(r" ?[^\W_]+| ?(?:[^\w\s]|_)+(?:(?<=')[^\W_]+)?|\s+(?!\S)|\s+").findall
        added = sorted(tokenizer.get_added_tokens_decoder().values(), key=lambda t: -len(t.content))
        marks = [t.content for t in added]
        at_marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")").split

        def find(text: str) -> list[str]:
            if not any(m in text for m in marks):
                return words(text)
            return [c for k, part in enumerate(at_marks(text)) for c in ([part] if k % 2 else words(part))]

        if any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added):
            _encoders[path, chunks] = ChunkCache(lambda text: [text], encode_many, 1)
        else:
            _encoders[path, chunks] = ChunkCache(find, encode_many, chunks)
    return _encoders[path, chunks]


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc) of a document's ids: full pieces, only the first may be shorter."""
    n = len(ids) // 4
    head = n % capacity
    bounds = [0, *([head] if head else []), *range(head + capacity, n + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", chunks: int = CHUNKS) -> DataFrame:
    """Pieces of at most capacity ids: id_col, piece, start, length, ids_crc32. A null text is empty: one end id."""
    tail = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf(PIECES)
    def pieces(texts: pa.Array) -> pa.Array:
        encoder = byte_level_encoder(tokenizer_path, chunks)
        rows = [cut(ids + tail, capacity) for ids in encoder.encode([t or "" for t in texts.to_pylist()])]
        flat = np.array([p for r in rows for p in r], np.int64).reshape(-1, 4)
        offsets = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(flat[:, 0].astype(np.int32)), *(pa.array(flat[:, k]) for k in (1, 2, 3))], fields=list(_arrow_pieces.value_type))
        del rows
        give_back()
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return docs.select(F.col(id_col), F.explode(pieces(F.col(text_col))).alias("_p")).select(id_col, "_p.*")


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where the documents of each size go: rows (size, first rank, number, first sequence, offset).

    Row by row, documents of a size from a first rank on go to as many sequences in a row, at one offset. Sizes
    over half the capacity open sequences. Then bulk-synchronous rounds: from the largest size down, gaps wait on
    a stack and each document takes the smallest gap that waits, gaps are updated after the sweep, and what is
    left goes to the next round. When nothing fits, what is left opens as few sequences as its volume needs, and
    their gaps take part in the rounds that follow, until no document is left.
    """
    left, used, rows, opened = {s: n for s, n in counts.items() if n}, dict.fromkeys(counts, 0), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # by size: sequences as (first, number)

    def put(size: int, n: int, first: int, gap: int) -> tuple[int, int, int]:
        rows.append((size, used[size], n, first, capacity - gap))
        used[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]
        return gap - size, first, n

    def wait(changed: list[tuple[int, int, int]]) -> None:
        for gap, first, n in changed:
            gaps.setdefault(gap, []).append((first, n))

    def open_sequences(size: int, n: int) -> None:
        nonlocal opened
        wait([put(size, n, opened, capacity)])
        opened += n

    for size in [s for s in left if s * 2 > capacity]:
        open_sequences(size, left[size])
    while left:
        least, stack, changed = min(left), [], []
        for size in sorted({*gaps, *left}, reverse=True):
            if size < least:  # such gaps can't take what is left
                break
            stack += [(size, *g) for g in gaps.pop(size, ())]
            while stack and size in left:
                gap, first, n = stack.pop()
                k = min(n, left[size])
                changed.append(put(size, k, first, gap))
                if k < n:
                    stack.append((gap, first + k, n - k))
        wait(stack)
        wait(changed)
        if not changed:
            need = -(-sum(s * n for s, n in left.items()) // capacity)
            for size in sorted(left, reverse=True):
                k = min(need, left[size])
                need -= k
                if k:
                    open_sequences(size, k)
    return np.array(rows, np.int64).reshape(-1, 5)


def ranked(items: DataFrame, rows_per_task: int) -> DataFrame:
    """key, size, part and the rank among the part's items of a size, by a hash of the key.

    Parts are ranges of size and hash, so that one common length splits.
    """

    def made(batches):
        part, last, n = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("size").to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], sizes[1:] != sizes[:-1]]))
                runs = np.diff(np.append(starts, len(sizes)))
                rank = np.arange(len(sizes)) - np.repeat(starts, runs)
                if sizes[0] == last:
                    rank[: runs[0]] += n
                last, n = sizes[-1], rank[-1] + 1
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("size"), pa.array(np.full(len(sizes), part, np.int64)), pa.array(rank)], ["key", "size", "part", "rank"])

    parts = max(1, -(-items.count() // rows_per_task))
    hashed = items.withColumn("h", F.xxhash64("key"))
    return stored(hashed.repartitionByRange(parts, "size", "h").sortWithinPartitions("size", "h", "key").mapInArrow(made, "key long, size long, part long, rank long"), "packing-ranks")


def best_fit(items: DataFrame, capacity: int = 1024, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Places items (key long, unique; length long, 1 to capacity) in sequences: key, sequence_id, offset.

    Items are sorted into ranges of size and ranked there. Those of one size are alike, and so are equal gaps, so a
    sweep is over counts: plan() matches the items of all sizes at once, at every number of them, and the driver
    holds a count a size (capacity at most) and the rows of the plan, some for each size and round. Items then
    look up their rank within their size. sequence_id is the key of the sequence's first item.
    """
    items = ranked(items.select(F.col("key").cast("long").alias("key"), F.col("length").cast("long").alias("size")), rows_per_task)
    parts = stored(items.groupBy("part", "size").agg(F.count("*").alias("n")), "packing-parts")
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long")).drop("n")
    totals = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # capacity at most
    rows = plan(totals, capacity)
    shared = items.sparkSession.sparkContext.broadcast(rows[np.lexsort((rows[:, 1], rows[:, 0]))])

    def found(batches):
        rows = shared.value
        heads = (rows[:, 0] << 44) + rows[:, 1]
        for batch in batches:
            key, size, rank, ahead = (batch.column(c).to_numpy() for c in ("key", "size", "rank", "ahead"))
            rank = rank + ahead
            row = rows[np.searchsorted(heads, (size << 44) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key, row[:, 3] + rank - row[:, 1], row[:, 4])], ["key", "sequence", "offset"])

    placed = items.join(small(ahead, SMALL_SIDE), ["part", "size"]).select("key", "size", "rank", "ahead")
    spots = placed.mapInArrow(found, "key long, sequence long, offset long")
    firsts = spots.where("offset = 0").select("sequence", F.col("key").alias("sequence_id"))
    return spots.join(firsts, "sequence").select("key", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", chunks: int = CHUNKS) -> DataFrame:
    """Packs documents into sequences of at most capacity ids.

    A document is its ids and one end_id; one that is longer than capacity is cut into full pieces, of which
    the first may be shorter. Columns: id_col, piece (from 0), start (ids before it in its document), length,
    ids_crc32 (of little-endian unsigned 32-bit ids), sequence_id, offset (gapless from 0 in a sequence).
    Null texts and empty ones become one end id. Repeated rows and ids are packed each; null ids stay null.
    An empty table gives no rows. Columns besides id and text are ignored, whatever their names. chunks: distinct
    chunks that a worker keeps the ids of; more cost memory and save encoding.
    """
    small_batches(docs.sparkSession)
    pieces = token_pieces(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), tokenizer_path, capacity, end_id, "_id", "_text", chunks)
    pieces = stored(pieces.withColumn("_key", F.monotonically_increasing_id()), "packing-pieces")
    spots = best_fit(pieces.select(F.col("_key").alias("key"), "length"), capacity).withColumnRenamed("key", "_key")
    return pieces.join(spots, "_key").select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
