"""Language-model scores from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks as B
from .common import Words, mix64, spans_of_bytes, stored, text_buffer
from .suffixes import by_key

#: Bits of the filter for each event in it, and probes of an event.
BITS_PER_EVENT, PROBES = 14, 4
#: Counts are rounded to powers of 2 ** (1 / STEPS), so by a twelfth at most.
STEPS = 4
#: Longest n-grams, and the weight of the shorter n-gram's probability against counts of the longer one's context.
ORDER, PRIOR = 3, 4.0
#: The end of a document, a token like words; no word hashes to it but by a 64-bit chance.
END = np.uint64(0x1F83D9ABFB41BD6B)
#: Bytes of a model that score_with() broadcasts at most.
MOST_BROADCAST = 64 << 20
#: Documents are trained on unless crc32 of their id's digits leaves this rest.
FOLDS, HELD_OUT = 7, 2


def held_out(ids: list) -> np.ndarray:
    """crc32(id as text) mod FOLDS is HELD_OUT; a null id is the empty text."""
    return np.array([zlib.crc32(str("" if i is None else i).encode()) % FOLDS == HELD_OUT for i in ids], bool)


class Tokens:
    """Tokens of a block's documents: hashes of words (A-Z lowered) and an end each, and n-grams up to ORDER.

    grams[n - 2] holds for each token a hash of it and the n - 1 before it; an end stands before each document.
    """

    def __init__(self, rows: pa.Table, id_col: str, text_col: str):
        text = rows.column(text_col).combine_chunks() if rows.num_rows else pa.array([], pa.string())
        raw, offsets = text_buffer(text if isinstance(text, pa.Array) else text.chunk(0))
        self.ids = rows.column(id_col).to_pylist()
        self.held = held_out(self.ids)
        hashes, counts = [], []
        for a, b in spans_of_bytes(offsets):
            w = Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
            hashes.append(w.hashes())
            counts.append(np.diff(w.first))
        n = (np.concatenate(counts) if counts else np.zeros(0, np.int64)) + 1
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.token = np.full(self.first[-1], END)
        ends = np.zeros(len(self.token), bool)
        ends[self.first[1:] - 1] = True
        if len(hashes):
            self.token[~ends] = np.concatenate(hashes)
        self.head = np.zeros(len(self.token), bool)
        self.head[self.first[:-1]] = True
        self.grams = [self.after(self.token)]
        for _ in range(ORDER - 2):
            self.grams.append(self.after(self.grams[-1]))
        self.train = np.repeat(~self.held, n)


    def before(self, values: np.ndarray, none) -> np.ndarray:
        """The value of the token before each, none at heads of documents."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.head] = none
        return out

    def after(self, context: np.ndarray) -> np.ndarray:
        """Hashes of each token behind the context that ends at the one before it."""
        return mix64(self.before(context, END) * np.uint64(0xA24BAED4963EE407) + self.token)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of 64-bit keys, in order."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs (or the sum of its weights)."""
    order, bounds = by_key(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    return keys[order[bounds[:-1]]], np.diff(bounds) if weights is None else np.add.reduceat(weights[order], bounds[:-1])


def cells(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 32 bits of each n-gram: what exchanges know it by. One in thousands shares a cell, at any size."""
    return (shard_of(keys, shards).astype(np.uint64) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


def packed(sorted_cells: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as 3-byte steps; the largest step says that the next one goes on from there."""
    most = (1 << 24) - 1
    more, rest = np.divmod(np.diff(sorted_cells & np.uint64(0xFFFFFFFF), prepend=np.uint64(0)).astype(np.int64), most)
    out = np.full(len(more) + more.sum(), most, "<u4")
    out[np.cumsum(more + 1) - 1] = rest
    return out.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The numbers of packed()."""
    step = np.zeros((len(data) // 3, 4), np.uint8)
    step[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    step = step.view("<u4").ravel().astype(np.uint64)
    return np.cumsum(step)[step != (1 << 24) - 1]


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(STEPS * log2 of the count), the number of events a count puts into the filter; 0 for none."""
    return np.where(counts > 0, 1 + np.floor(STEPS * np.log2(np.maximum(counts, 1)) + 1e-9), 0).astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """Counts that levels stand for: the mean of the whole numbers that have the level; 0 for none."""
    low, high = (np.ceil(2.0 ** ((level.astype(np.float64) - k) / STEPS) - 1e-9) for k in (1, 0))
    return np.where(level > 0, (low + np.maximum(high - 1, low)) / 2, 0.0)


class LogFilter:
    """A Bloom filter of (n-gram, level) events with room for all of them.

    A count is held as its level: the n-gram is inserted once for each level up to it, and read back by
    probing level after level until one is missing. A false positive can only raise a level.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        level = levels(counts)
        self.bits = (int(level.sum()) * BITS_PER_EVENT + 512) // 64 * 64
        set_bits = np.zeros(self.bits, bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            keys, level = keys[level >= j], level[level >= j]
            for at in self.places(keys, j):
                set_bits[at] = True
        self.data = np.packbits(set_bits, bitorder="little")

    @classmethod
    def of(cls, data: bytes, bits: int) -> LogFilter:
        """A filter as it was kept."""
        out = cls.__new__(cls)
        out.bits, out.data = bits, np.frombuffer(data, np.uint8)
        return out

    def places(self, keys: np.ndarray, level: int) -> list[np.ndarray]:
        g = mix64(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
        low, high = g & np.uint64(0xFFFFFFFF), (g >> np.uint64(32)) | np.uint64(1)
        return [((low + np.uint64(i) * high) % np.uint64(self.bits)).astype(np.int64) for i in range(PROBES)]

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level found by probing, 0 for none."""
        level, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for j in range(1, 256):
            found = np.ones(len(alive), bool)
            for at in self.places(keys[alive], j):
                found &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            alive = alive[found]
            if not len(alive):
                break
            level[alive] = j
        return level


@dataclass
class Segment:
    """What a shard has learnt: its part of the filter, and its tokens with their exact counts."""

    lf: LogFilter
    tokens: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, row: dict | None) -> Segment:
        """A segment as it was kept; of a shard that has learnt nothing, without a row, one that knows nothing."""
        if row is None:
            return cls(LogFilter(np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return cls(LogFilter.of(row["bits"], row["n_bits"]), np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["counts"], "<u8").astype(np.int64))

    def answer(self, keys: np.ndarray, grams: list[np.ndarray]) -> bytes:
        """The exact counts of tokens, then the levels that probes find for them and for n-grams (32 bits each, by order)."""
        at = np.minimum(np.searchsorted(self.tokens, keys), max(len(self.tokens) - 1, 0))
        exact = np.where(self.tokens[at] == keys, self.counts[at], 0) if len(self.tokens) else np.zeros(len(keys), np.int64)
        asked = [keys, *(gram_keys(g, k) for k, g in enumerate(grams))]
        return exact.astype("<u8").tobytes() + b"".join(self.lf.level(q).astype(np.uint8).tobytes() for q in asked)


@dataclass
class Model:
    """A language model: segments of the filter (written, one row a shard), how many shards, tokens and kinds of them."""

    segments: DataFrame
    shards: int
    n: int
    v: int

    def size(self) -> int:
        return self.segments.agg(F.sum(F.octet_length("bits") + F.octet_length("tokens") + F.octet_length("counts"))).first()[0] or 0


SEGMENT = "struct<bits:binary,n_bits:bigint,tokens:binary,counts:binary>"
_arrow_segment = pa.struct([("bits", pa.binary()), ("n_bits", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])


def gram_keys(low: np.ndarray, k: int) -> np.ndarray:
    """What the filter knows an n-gram of the k-th longer order by, from the 32 bits that it has within its shard."""
    return mix64(low.astype(np.uint64) + np.uint64((k + 1) << 32))


def distinct(t: Tokens, shards: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each order: the distinct tokens (or n-grams, as cells) in order, which one each token of the block ends, and
    where those of each shard begin (one more than shards)."""
    out = []
    for k, keys in enumerate((t.token, *(cells(g, shards) for g in t.grams))):
        order, cut = by_key(keys)
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        mine = keys[order[cut[:-1]]]
        owner = (mine >> np.uint64(32)).astype(np.int64) if k else shard_of(mine, shards)
        out.append((mine, which, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=shards))])))
    return out


def scored(blocks: DataFrame, replies: DataFrame | None, shards: int, n: int, v: int, id_field, told_here: Callable[[list], dict[int, bytes]] | None = None) -> DataFrame:
    """The scores of blocks' documents from what shards told of their tokens and n-grams (or told_here finds out)."""
    id_type = to_arrow_type(id_field.dataType)

    def made(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                t = Tokens(B.opened(batch.column("data")[k]), "id", "text")
                orders = distinct(t, shards)
                told = B.earlier(batch.column("answer0")[k]) if told_here is None else told_here(orders)
                sizes = [np.diff(begin).tolist() for _, _, begin in orders]
                exact, rough = [], [[] for _ in orders]
                for i in sorted(told):
                    at = 8 * sizes[0][i]
                    exact.append(told[i][:at])
                    for parts, size in zip(rough, sizes, strict=True):
                        parts.append(told[i][at : at + size[i]])
                        at += size[i]
                known = np.frombuffer(b"".join(exact), "<u8").astype(np.float64)[orders[0][1]]
                counts = [middle(np.frombuffer(b"".join(r), np.uint8))[which] for r, (_, which, _) in zip(rough, orders, strict=True)]
                base = np.log10((known + 1) / (n + 1 * (v + 1)))
                p = (counts[0] + 1) / (n + v + 1)
                starts = counts[0][t.first[1:] - 1].max(initial=0.0)  # documents: as often as ends
                for lower, own in zip(counts, counts[1:], strict=False):
                    context = t.before(lower, starts)
                    p = (np.minimum(own, context) + PRIOR * p) / (context + PRIOR)
                first = t.first[:-1]
                sums = [np.add.reduceat(x, first) if len(first) else np.zeros(0) for x in (known > 0, base, np.log10(p))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.ids, id_type), pa.array(t.held), pa.array(np.diff(t.first)), pa.array(sums[0].astype(np.int64)), pa.array(np.full(len(first), n, np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    rows = blocks if replies is None else B.joined(blocks, (replies,))
    return rows.mapInArrow(made, f"id {id_field.dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scores of fitted(), without a model that stays."""
    return fitted(docs, id_col, text_col, keep=False)[0]


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> tuple[DataFrame, Model]:
    """Language-model scores of whole texts (id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), and
    the model, which score_with() takes for other documents; its segments are written only to keep it.

    Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z lowered and one end for each document; a null or empty text
    is an end alone. What is learnt comes from the documents that held_out() leaves. base_score: add-one
    probabilities from exact counts. score: n-grams up to ORDER, each order's count plus PRIOR times the shorter
    one's probability over the context's count plus PRIOR, down to an add-one probability, all counts read from the
    log-frequency filter; an end stands before a document. A null id counts as the empty text, so it trains.
    Repeated rows each count. Other columns are ignored; an empty table gives no rows.

    Blocks send their distinct tokens and n-grams with counts to shards by hash, those of held-out documents with
    a count of 0. A shard adds them up, sets the bits of its segment of the filter, which is as large as its
    n-grams need, and answers each block with the exact counts of its tokens and with the levels that probes of
    the segment find for its tokens and n-grams. So the filter grows with the n-grams and is never in one place.
    """
    blocks = B.packed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    shards = B.shard_count(blocks)
    orders = range(ORDER - 1)

    def bounds(found: np.ndarray, present: np.ndarray) -> list[list[int]]:
        return [np.searchsorted(found, present, side).tolist() for side in ("left", "right")]

    def ask(rows: pa.Table, _):
        t = Tokens(rows, "id", "text")
        train = t.train.astype(np.int64)
        keys, counts = counted(t.token, train)
        grams = [counted(cells(g, shards), train) for g in t.grams]
        found = [shard_of(keys, shards), *((g >> np.uint64(32)).astype(np.int64) for g, _ in grams)]
        present = np.unique(np.concatenate(found))
        for s, *at in zip(present.tolist(), *(x for f in found for x in bounds(f, present)), strict=True):
            (a, b), rest = at[:2], [at[2 * k + 2 : 2 * k + 4] for k in orders]
            yield s, keys[a:b].tobytes(), counts[a:b].astype("<u4").tobytes(), *(x for (g, n), (p, q) in zip(grams, rest, strict=True) for x in (packed(g[p:q]), n[p:q].astype("<u4").tobytes()))

    def reply(table: pa.Table) -> pa.Table:
        def column(name: str, kind) -> tuple[np.ndarray, np.ndarray]:
            parts = table.column(name).to_pylist()
            return np.frombuffer(b"".join(parts), kind), np.cumsum([0] + [len(p) for p in parts]) // np.dtype(kind).itemsize

        keys, ends = column("keys", np.uint64)
        known, total = counted(keys, column("counts", "<u4")[0].astype(np.int64))
        events, sums, asked, cuts = [known], [total], [keys], [ends]
        for k in orders:
            parts = [unpacked(p) for p in table.column(f"grams{k}").to_pylist()]
            asked.append(gram_keys(np.concatenate(parts), k))
            cuts.append(np.cumsum([0] + [len(p) for p in parts]))
            grams, n = counted(asked[-1], column(f"counts{k}", "<u4")[0].astype(np.int64))
            events.append(grams)
            sums.append(n)
        seen = [n > 0 for n in sums]
        lf = LogFilter(np.concatenate([e[s] for e, s in zip(events, seen, strict=True)]), np.concatenate([n[s] for n, s in zip(sums, seen, strict=True)]))
        segment = {"bits": lf.data.tobytes(), "n_bits": lf.bits, "tokens": known[seen[0]].tobytes(), "counts": total[seen[0]].astype("<u8").tobytes()} if keep else None
        told = total[np.searchsorted(known, keys)].astype("<u8")
        rough = [lf.level(e).astype(np.uint8)[np.searchsorted(e, q)] for e, q in zip(events, asked, strict=True)]
        n = table.num_rows
        replies = [told[ends[i] : ends[i + 1]].tobytes() + b"".join(r[c[i] : c[i + 1]].tobytes() for r, c in zip(rough, cuts, strict=True)) for i in range(n)]
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()] * (n + 1), pa.int32()),
            "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
            "reply": pa.array([*replies, None], pa.binary()),
            "tokens": pa.array([0] * n + [int(total.sum())], pa.int64()),
            "types": pa.array([0] * n + [int(seen[0].sum())], pa.int64()),
            "segment": pa.array([None] * n + [segment], _arrow_segment),
        })

    asked = B.asked(blocks, ask, "keys binary, counts binary, " + ", ".join(f"grams{k} binary, counts{k} binary" for k in orders))
    replies = stored(asked.groupBy("shard").applyInArrow(reply, f"shard int, block long, reply binary, tokens long, types long, segment {SEGMENT}"), "ngram-counts")
    sums = replies.agg(F.sum("tokens"), F.sum("types")).first()
    n, v = sums[0] or 0, sums[1] or 0

    out = scored(blocks, replies.where("block is not null").select("shard", "block", "reply"), shards, n, v, docs.schema[id_col])
    model = Model(replies.where("segment is not null").select("shard", "segment.*"), shards, n, v)
    return out.withColumnRenamed("id", id_col), model


def score_with(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = MOST_BROADCAST) -> DataFrame:
    """The scores, as fitted() tells them, of documents that the model need not have learnt from.

    A model of at most most_bytes is broadcast and each block probes it in place. A larger one stays where it is: blocks
    ask its shards, a job that reads each segment once and probes it for all of them.
    """
    spark, shards = docs.sparkSession, model.shards
    blocks = B.packed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    if model.size() <= most_bytes:
        sent = spark.sparkContext.broadcast({r["shard"]: r.asDict() for r in model.segments.collect()})
        opened: dict[int, Segment] = {}

        def told_here(orders: list) -> dict[int, bytes]:
            out = {}
            for s in range(shards):
                keys, *grams = (mine[begin[s] : begin[s + 1]] for mine, _, begin in orders)
                if s not in opened:
                    opened[s] = Segment.of(sent.value.get(s))
                if len(keys) or any(map(len, grams)):
                    out[s] = opened[s].answer(keys, [g & np.uint64(0xFFFFFFFF) for g in grams])
            return out

        return scored(blocks, None, shards, model.n, model.v, docs.schema[id_col], told_here).withColumnRenamed("id", id_col)

    def ask(rows: pa.Table, _):
        orders = distinct(Tokens(rows, "id", "text"), shards)
        for s in range(shards):
            keys, *grams = (mine[begin[s] : begin[s + 1]] for mine, _, begin in orders)
            if len(keys) or any(map(len, grams)):
                yield s, keys.tobytes(), *(packed(g) for g in grams)

    def reply(questions: pa.Table, kept: pa.Table) -> pa.Table:
        segment = Segment.of(kept.to_pylist()[0] if kept.num_rows else None)
        replies = []
        for q in questions.to_pylist():
            replies.append(segment.answer(np.frombuffer(q["keys"], np.uint64), [unpacked(q[f"grams{k}"]) for k in range(ORDER - 1)]))
        return pa.table({"shard": questions.column("shard"), "block": questions.column("block"), "reply": pa.array(replies, pa.binary())})

    asked = B.asked(blocks, ask, "keys binary, " + ", ".join(f"grams{k} binary" for k in range(ORDER - 1)))
    replies = asked.groupBy("shard").cogroup(model.segments.groupBy("shard")).applyInArrow(reply, "shard int, block long, reply binary")
    return scored(blocks, stored(replies, "ngram-replies"), shards, model.n, model.v, docs.schema[id_col]).withColumnRenamed("id", id_col)
