"""What several corpus operators need: shared scratch tables, byte-level word tables, chunked text."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import shared_path

#: Text bytes that numpy works on at once (one longer document is worked on alone), and characters of texts whose
#: chunks are looked up at once.
CHUNK_BYTES, LOOKUP_CHARS = 1 << 18, 1 << 20

#: Rows of a side that joins broadcast; hot keys that they broadcast beyond it, and the least rows of one.
SMALL_SIDE, MOST_HOT, LEAST_HOT = 200_000, 10_000, 100


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: its lineage ends there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, side: DataFrame, key: str | list[str], count: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with side, a written table with one row of each key, of which count says how
    many of rows have it.

    A side of at most SMALL_SIDE rows is broadcast. Of a larger one, keys with more than a MOST_HOT-th of all
    rows are broadcast, which are MOST_HOT at most, and only the rest is shuffled, so no key is one task's.
    """
    keys = [key] if isinstance(key, str) else key
    n, total = side.agg(F.count("*"), F.sum(count)).first()
    if n <= SMALL_SIDE:
        return rows.join(F.broadcast(side), keys, how)
    least = max((total or 0) // MOST_HOT, LEAST_HOT)
    hot = side.where(F.col(count) > least)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(side.where(F.col(count) <= least), keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1000 rows or 4 MB from now on: 10000 rows, Spark's default, are tens of MB of
    text several times over, in a task's JVM and in its worker. A smaller setting of the session stays."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)):
        now = str(spark.conf.get(key)).lower().rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Hands freed memory back to the system: a worker serves one operator after another, and without this the
    highest use of each would stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(texts) else raw[:0], offsets - offsets[0]


def spans_of_bytes(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Consecutive row ranges (a, b) of about limit bytes each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def cut_texts(raw: np.ndarray, offsets: np.ndarray, marks: np.ndarray, most: int):
    """Pieces (row, start, end) of texts, of about most bytes at most: longer texts are cut behind a byte that marks
    (256 booleans) has, whose next one may lie further off."""
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while b - a > most:
            found = np.flatnonzero(marks[raw[a : a + most]])
            if len(found):
                step = int(found[-1]) + 1
            else:
                found = np.flatnonzero(marks[raw[a + most : b]])
                step = most + int(found[0]) + 1 if len(found) else b - a
            yield row, a, a + step
            a += step
        if b > a:
            yield row, a, b


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """Words [^\\x20\\x09-\\x0D]+ of some documents: where they lie and 64-bit hashes of them.

    start, end: byte positions of each word; first: index of each document's first word, n + 1 long.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n = len(raw)
        inside = ~SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        starts = inside & (~before | edge[:-1])
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends = inside & (~after | edge[1:])
        self.raw, self.inside = raw, inside
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.lower = lower

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """A hash of raw[start:end] for each pair, by default of each word."""
        start, end = (self.start if start is None else start), (self.end if end is None else end)
        if not hasattr(self, "_sums"):
            up, self._down = powers(len(self.raw) + 1)
            self._sums = np.zeros(len(self.raw) + 1, np.uint64)
            np.cumsum((LOWER_VALUE if self.lower else BYTE_VALUE)[self.raw] * up[:-1], out=self._sums[1:])
        out = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix64(out + (end - start).astype(np.uint64))


def runs_of_words(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word runs inside documents, and the first run of each document (n + 1 long).

    A document with words but fewer than n has its whole sequence as its only run.
    """
    counts = np.diff(first)
    per = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    if not len(hashes):
        return np.zeros(0, np.uint64), bounds
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    mult = np.uint64(0xA24BAED4963EE407)
    acc = padded[: len(hashes)].copy()
    for j in range(1, n):
        acc = acc * mult + padded[j : j + len(hashes)]
    acc = mix64(acc)
    where = np.repeat(first[:-1] - bounds[:-1], per) + np.arange(bounds[-1])
    out = acc[where]
    for d in np.flatnonzero((counts > 0) & (counts < n)):  # short documents: the sequence as one
        h = 0
        for w in hashes[first[d] : first[d + 1]].tolist():
            h = (h * 0xA24BAED4963EE407 + w) & (2**64 - 1)
        out[bounds[d]] = mix64(np.array([h ^ 0x5851F42D4C957F2D * int(counts[d]) & (2**64 - 1)], np.uint64))[0]
    return out, bounds


class ChunkCache:
    """Encodes texts through a bounded dictionary of their chunks, as most chunks come again.

    find(text) must cut where the tokenizer can't join the two sides; encode_many(chunks) gives the ids of
    each chunk as little-endian unsigned 32-bit bytes. At most limit chunks are kept.
    """

    def __init__(self, find, encode_many, limit: int = 400_000):
        self.find, self.encode_many, self.limit, self.known = find, encode_many, limit, {}

    def encode(self, texts: list[str]):
        """The ids of each text, as bytes."""
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size < LOOKUP_CHARS):
                size += len(texts[b])
                b += 1
            cut = [self.find(t) for t in texts[a:b]]
            wanted = set().union(*cut)
            missing = [c for c in wanted if c not in self.known]
            if len(self.known) + len(missing) > self.limit:
                self.known, missing = {}, list(wanted)
            if missing:
                self.known.update(zip(missing, self.encode_many(missing), strict=True))
            get = self.known.__getitem__
            for c in cut:
                yield b"".join(map(get, c))
            a = b
