"""Long repeated passages across documents, by a family of sorted suffix tables that grow geometrically."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks as B
from .common import BYTE_VALUE, give_back, mix64, powers, spans_of_bytes, stored, text_buffer

#: Bytes of a match, of the k-grams that anchor it, and k-grams in a match.
MATCH, GRAM = 50, 20
WINDOW = MATCH - GRAM + 1
WIDTH = MATCH - 1 + WINDOW
#: Bits of the position beside a k-gram's hash when the least of a window is sought; windows worked on at once.
AT = 24
MOST_WINDOWS = 1 << 22
#: Suffixes of a batch of the index family, at least.
BATCH = 16_384
#: Distinct suffixes of one anchor beyond which its strings are dealt by themselves; runs of an anchor in a block
#: from which on they are told apart when counted.
HOT_SUFFIXES, MANY = 50_000, 16
NO_ID = np.iinfo(np.int64).max


def anchors(raw: np.ndarray, offsets: np.ndarray):
    """The anchored runs of documents: key (48 bits), doc, left (byte), wins.

    The anchor of a MATCH-byte string is the leftmost of its k-grams with the least hash, so equal strings
    have equal anchors at equal places. A run is up to WINDOW consecutive strings with one anchor.
    """
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in spans_of_bytes(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        for s in range(lo, max(hi - MATCH + 1, lo), MOST_WINDOWS):  # more than one step for a very long text only
            e = min(hi, s + MOST_WINDOWS + MATCH - 1)
            part = raw[s:e]
            n = len(part) - MATCH + 1
            if n <= 0:
                continue
            up, down = powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(BYTE_VALUE[part] * up[:-1], out=sums[1:])
            g = len(part) - GRAM + 1
            h = mix64((sums[GRAM:] - sums[:g]) * down[:g])
            least = (h & ~np.uint64((1 << AT) - 1)) | np.arange(g, dtype=np.uint64)
            width = 1
            while width * 2 <= WINDOW:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            rest = WINDOW - width
            least = np.minimum(least[: len(least) - rest], least[rest:])
            place = (least & np.uint64((1 << AT) - 1)).astype(np.int64)
            inner = offsets[a : b + 1] - s
            ends = inner[(inner > 0) & (inner < len(part))]
            valid = np.zeros(n + 1, np.int32)  # strings that cross the end of a document don't count
            np.add.at(valid, np.clip(ends - MATCH + 1, 0, n), 1)
            np.add.at(valid, np.clip(ends, 0, n), -1)
            valid = np.cumsum(valid[:-1]) == 0
            new = np.ones(n, bool)
            new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
            first = np.flatnonzero(new)
            wins = np.diff(np.append(first, n))
            ok = valid[first]
            first, wins = first[ok], wins[ok]
            # mixed once more, as least hashes crowd at the low end of the key space
            out.append((mix64(h[place[first]]) >> np.uint64(16), np.searchsorted(offsets, first + s, "right") - 1, first + s, wins))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def by_key(key: np.ndarray):
    """A stable order by key, and the bounds of equal keys in it."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return order, np.append(first, len(k))


class Block:
    """A block's rows with their anchored runs."""

    def __init__(self, rows: pa.Table, id_col: str, text_col: str, shards: int):
        self.rows, self.shards = rows, shards
        text = rows.column(text_col).combine_chunks() if rows.num_rows else pa.array([], pa.string())
        self.raw, self.offsets = text_buffer(text if isinstance(text, pa.Array) else text.chunk(0))
        self.ids = np.array(rows.column(id_col).cast(pa.int64()).fill_null(NO_ID).to_numpy())
        self.key, self.doc, self.left, self.wins = anchors(self.raw, self.offsets)
        self.order, self.bounds = by_key(self.key)
        self.keys = self.key[self.order[self.bounds[:-1]]]

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        """The shard of each 48-bit key: equal ranges, in order."""
        return (((keys >> np.uint64(16)) * np.uint64(self.shards)) >> np.uint64(32)).astype(np.int64)

    def parts(self, keys: np.ndarray):
        """(shard, a, b) of sorted keys."""
        shard = self.shard_of(keys)
        first = np.flatnonzero(np.concatenate([np.ones(min(len(shard), 1), bool), shard[1:] != shard[:-1]])).tolist()
        return list(zip(shard[first].tolist(), first, [*first[1:], len(shard)][: len(first)], strict=True))

    def prints(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hashes of raw[at : at + size], which lie in one document each."""
        out = np.zeros(len(at), np.uint64)
        for a, b in spans_of_bytes(self.offsets):  # sums over one stretch at a time
            lo, hi = int(self.offsets[a]), int(self.offsets[b])
            mine = np.flatnonzero((at >= lo) & (at < hi))
            if len(mine):
                up, down = powers(hi - lo + 1)
                sums = np.zeros(hi - lo + 1, np.uint64)
                np.cumsum(BYTE_VALUE[self.raw[lo:hi]] * up[:-1], out=sums[1:])
                s = at[mine] - lo
                out[mine] = mix64((sums[s + size[mine]] - sums[s]) * down[s])
        return out

    def contents(self, runs: np.ndarray) -> np.ndarray:
        """Hashes of runs, equal if their strings are."""
        return self.prints(self.left[runs], self.wins[runs] + MATCH - 1) + self.wins[runs].astype(np.uint64)

    def ask_keys(self):
        """Distinct keys, 6 bytes each, and of each a byte: whether more than one document here has it, and how many
        distinct suffixes it has here at most, as a logarithm."""
        ids = self.ids[self.doc[self.order]]
        first, n = self.bounds[:-1], np.diff(self.bounds)
        several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first) if len(first) else np.zeros(0, bool)
        many = np.repeat(n > MANY, n)
        if many.any():
            group = np.repeat(np.arange(len(n)), n)[many]
            content = self.contents(self.order[many])
            order = np.lexsort((content, group))
            group, content = group[order], content[order]
            new = np.ones(len(group), bool)
            new[1:] = (group[1:] != group[:-1]) | (content[1:] != content[:-1])
            n = np.where(n > MANY, np.bincount(group[new], minlength=len(n)), n)
        said = (np.log2(np.maximum(n, 1)).astype(np.uint8) | (several.astype(np.uint8) << 7)).astype(np.uint8)
        six = self.keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
        for s, a, b in self.parts(self.keys):
            yield s, six[a:b].tobytes(), said[a:b].tobytes()

    def share(self, told: dict[int, bytes]) -> None:
        """Keeps the runs whose key other documents have too, grouped by key and content; of hot keys the strings."""
        hit, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for s, a, b in self.parts(self.keys):
            bits = np.frombuffer(told[s], np.uint8)
            hit[a:b], hot[a:b] = (np.unpackbits(x, count=b - a).astype(bool) for x in (bits[: len(bits) // 2], bits[len(bits) // 2 :]))
        n = np.diff(self.bounds)
        runs = self.order[np.repeat(hit & ~hot, n)]
        key, doc, left, wins, content = self.key[runs], self.doc[runs], self.left[runs], self.wins[runs], self.contents(runs)
        ids = self.ids[doc]
        order = np.lexsort((ids, content, key))
        self.key2, self.doc2, self.left2, self.wins2, self.ids2, content = (x[order] for x in (key, doc, left, wins, ids, content))
        new = np.ones(len(order), bool)
        new[1:] = (self.key2[1:] != self.key2[:-1]) | (content[1:] != content[:-1])
        self.heads = np.flatnonzero(new)  # the first has the least id
        self.group = np.cumsum(new) - 1
        runs = self.order[np.repeat(hot, n)]
        wins = self.wins[runs]
        self.hot_at = np.repeat(self.left[runs], wins) + np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins)
        self.hot_id = np.repeat(self.ids[self.doc[runs]], wins)
        order, bounds = by_key(self.prints(self.hot_at, np.full(len(self.hot_at), MATCH)))
        self.hot_at, self.hot_id = self.hot_at[order], self.hot_id[order]
        self.hot_n = np.diff(bounds)
        first = bounds[:-1]
        self.hot_print = self.prints(self.hot_at[first], np.full(len(first), MATCH))
        self.hot_least = np.minimum.reduceat(self.hot_id, first) if len(first) else self.hot_id

    def asked_parts(self):
        """(shard, suffixes from, to, strings from, to) of what ask_suffixes sends."""
        suffixes = {s: (a, b) for s, a, b in self.parts(self.key2[self.heads])}
        strings = {s: (a, b) for s, a, b in self.parts(self.hot_print >> np.uint64(16))}
        return [(s, *suffixes.get(s, (0, 0)), *strings.get(s, (0, 0))) for s in sorted({*suffixes, *strings})]

    def ask_suffixes(self):
        """Each distinct anchored suffix with its least id: n, keys, ids, wins, text (compressed); each distinct
        string at a hot anchor, with its least id: prints, least."""
        h = self.heads
        sizes = self.wins2[h] + MATCH - 1
        for s, a, b, p, q in self.asked_parts():
            size = sizes[a:b]
            at = np.repeat(self.left2[h[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield s, b - a, self.key2[h[a:b]].astype("<u8").tobytes(), self.ids2[h[a:b]].tobytes(), self.wins2[h[a:b]].astype(np.uint8).tobytes(), zlib.compress(self.raw[at].tobytes(), 1), self.hot_print[p:q].tobytes(), self.hot_least[p:q].tobytes()

    def removed(self, told: dict[int, bytes]) -> np.ndarray:
        """Whether each byte goes, from the masks of the distinct suffixes and the least ids of the strings."""
        masks, least = np.zeros(len(self.heads), np.uint32), np.zeros(len(self.hot_print), np.int64)
        for s, a, b, p, q in self.asked_parts():
            masks[a:b] = np.frombuffer(told[s], np.uint32, b - a)
            least[p:q] = np.frombuffer(told[s], np.int64, q - p, 4 * (b - a))
        mask, full = masks[self.group], (np.uint64(1) << self.wins2.astype(np.uint64)).astype(np.uint64) - np.uint64(1)
        whole = (self.ids2 > self.ids2[self.heads[self.group]]) | (mask == full)
        steps = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(steps, self.left2[whole], 1)
        np.add.at(steps, self.left2[whole] + self.wins2[whole] + MATCH - 1, -1)
        some = np.flatnonzero(~whole & (mask > 0))
        for j in range(WINDOW):
            at = self.left2[some[(mask[some] >> np.uint32(j)) & 1 > 0]] + j
            np.add.at(steps, at, 1)
            np.add.at(steps, at + MATCH, -1)
        at = self.hot_at[self.hot_id > np.repeat(least, self.hot_n)]
        np.add.at(steps, at, 1)
        np.add.at(steps, at + MATCH, -1)
        np.cumsum(steps, out=steps)
        return steps[:-1] > 0


class IndexFamily:
    """Sorted tables of suffixes with the least id of each; a table as large as the next one merges into it."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def table(suffixes: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        """The suffix array of a batch: its distinct suffixes in order, with their least id and a row of each."""
        order = np.lexsort((ids,)) if not len(suffixes) else np.argsort(suffixes, kind="stable")
        s = suffixes[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        return s[first], np.minimum.reduceat(ids[order], first) if len(first) else ids[:0], rows[order[first]]

    def add(self, suffixes: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scans a new batch against the levels, tells both sides the lesser id, and keeps what is new."""
        s, i, r = self.table(suffixes, ids, rows)
        for ls, li, _ in self.levels:
            at = np.minimum(np.searchsorted(ls, s), len(ls) - 1)
            known = ls[at] == s
            li[at[known]] = np.minimum(li[at[known]], i[known])
            s, i, r = s[~known], i[~known], r[~known]
        if len(s):
            self.levels.append((s, i, r))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * 2 > len(self.levels[-2][0]):
            self._merge()

    def _merge(self) -> None:
        last, before = self.levels.pop(), self.levels.pop()
        self.levels.append(self.table(*(np.concatenate([x, y]) for x, y in zip(before, last, strict=True))))

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0]


def window_masks(text: np.ndarray, wins: np.ndarray, key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For distinct suffixes: bits of the strings that a smaller id has under another suffix of the same key."""
    masks = np.zeros(len(key), np.uint32)
    order, bounds = by_key(key)
    several = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
    rows = order[several]
    if not len(rows):
        return masks
    up, down = powers(WIDTH + 1)
    sums = np.zeros((len(rows), WIDTH + 1), np.uint64)
    np.cumsum(BYTE_VALUE[text[rows]] * up[:WIDTH], axis=1, out=sums[:, 1:])
    prints, owner, bit = [], [], []
    for j in range(WINDOW):
        has = np.flatnonzero(wins[rows] > j)
        prints.append(mix64((sums[has, j + MATCH] - sums[has, j]) * down[j]))
        owner.append(rows[has])
        bit.append(np.full(len(has), j, np.uint32))
    prints, owner, bit = np.concatenate(prints), np.concatenate(owner), np.concatenate(bit)
    order, bounds = by_key(prints)
    least = np.minimum.reduceat(ids[owner[order]], bounds[:-1])
    earlier = np.repeat(least, np.diff(bounds)) < ids[owner[order]]
    hit = order[earlier]
    np.bitwise_or.at(masks, owner[hit], np.uint32(1) << bit[hit])
    return masks


def reply_keys(table: pa.Table) -> list[bytes]:
    """Which of a block's keys more than one document has, and which of them are hot: two sets of bits."""
    parts = [np.frombuffer(k.as_buffer(), np.uint8).reshape(-1, 6) for k in table.column("keys")]
    said = np.concatenate([np.frombuffer(f.as_buffer(), np.uint8) for f in table.column("said")])
    eight = np.zeros((sum(map(len, parts)), 8), np.uint8)
    eight[:, 2:] = np.concatenate(parts)
    key = eight.view(">u8").ravel().astype(np.uint64)
    order, bounds = by_key(key)
    first, n = bounds[:-1], np.diff(bounds)
    shared = (n > 1) | np.logical_or.reduceat(said[order] > 127, first)
    suffixes = np.add.reduceat(np.int64(1) << (said[order] & 127).astype(np.int64), first)
    hit, hot = np.empty(len(key), bool), np.empty(len(key), bool)
    hit[order], hot[order] = np.repeat(shared, n), np.repeat(shared & (suffixes > HOT_SUFFIXES), n)
    ends = np.cumsum([0] + [len(p) for p in parts])
    return [np.packbits(hit[a:b]).tobytes() + np.packbits(hot[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def reply_suffixes(table: pa.Table) -> list[bytes]:
    """A mask of each asked suffix: bit j if the string at its j-th byte starts in a document of smaller id; behind
    them the least id of each asked string."""
    n = np.array(table.column("n").to_pylist(), np.int64)
    key = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u8")
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.int64)
    wins = np.frombuffer(b"".join(table.column("wins").to_pylist()), np.uint8).astype(np.int64)
    ends = np.cumsum(n)
    out = suffix_masks(table, key, ids, wins, ends) if len(key) else np.zeros(0, np.uint32)
    prints = [np.frombuffer(p.as_buffer(), np.uint64) for p in table.column("prints")]
    cuts = np.cumsum([0] + [len(p) for p in prints])
    order, bounds = by_key(np.concatenate(prints))
    own = np.frombuffer(b"".join(table.column("least").to_pylist()), np.int64)
    least = np.empty(len(own), np.int64)
    if len(own):
        least[order] = np.repeat(np.minimum.reduceat(own[order], bounds[:-1]), np.diff(bounds))
    starts = ends - n
    return [out[a:b].tobytes() + least[p:q].tobytes() for a, b, p, q in zip(starts, ends, cuts[:-1], cuts[1:], strict=True)]


def suffix_masks(table: pa.Table, key: np.ndarray, ids: np.ndarray, wins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The masks of reply_suffixes, by an index family that takes blocks as batches."""
    flat = np.frombuffer(b"".join(zlib.decompress(t) for t in table.column("text").to_pylist()), np.uint8)
    sizes = wins + MATCH - 1
    text = np.zeros((len(key), WIDTH + 1), np.uint8)
    row = np.repeat(np.arange(len(key)), sizes)
    text[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    text[:, WIDTH] = wins  # parts suffixes that end in zero bytes
    suffix = text.view(f"S{WIDTH + 1}").ravel()
    family = IndexFamily()
    a = 0
    while a < len(key):
        b = int(ends[min(np.searchsorted(ends, a + BATCH), len(ends) - 1)])
        family.add(suffix[a:b], ids[a:b], np.arange(a, b))
        a = b
    known, least, rows = family.whole()
    masks = window_masks(text[rows, :WIDTH], wins[rows], key[rows], least)
    at = np.searchsorted(known, suffix)
    full = ((np.uint64(1) << wins.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    return np.where(ids > least[at], full, masks[at]).astype(np.uint32)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", replace: bool = False) -> DataFrame:
    """docs with _n_bytes, _n_removed, _n_spans and _kept (binary: the bytes that stay).

    With replace there is no _kept: the text itself becomes what stays, less the bytes of characters cut apart
    (a text that loses nothing stays as it is, null too).

    A byte goes if a MATCH-byte string that covers it also starts in a document with a smaller id. Texts are
    UTF-8 bytes; null is empty; matches never cross documents; all is judged on the input. A null id ranks
    after all ids, equal ids never remove from each other. Every row and column stays, but columns of the names
    above are replaced; an empty table stays empty.

    Suffix tables hold the suffixes at anchors (content-chosen places, one at least in each MATCH bytes), not
    those at all bytes: a shared string has its anchor at the same place everywhere, so nothing is missed and
    an index is a sixteenth of the text's suffixes. Blocks first ask which anchors are shared at all; only
    suffixes at those are sent, to shards by key. A shard takes blocks as batches: it sorts their suffixes,
    scans them against its levels, merges levels of a size, and last settles strings at the edges of matches.
    An anchor with very many different suffixes, as of a line that stands everywhere, is not one shard's: each of
    its strings goes to a shard of its own hash, once a block with the block's least id.
    """
    added = ("_n_bytes", "_n_removed", "_n_spans", *(() if replace else ("_kept",)))
    docs = docs.drop(*(c for c in added if c != text_col and c != id_col))
    blocks = B.packed(docs, text_col)
    shards = B.shard_count(blocks)

    def block(rows: pa.Table) -> Block:
        return Block(rows, id_col, text_col, shards)

    def keys(rows, _):
        return block(rows).ask_keys()

    def suffixes(rows, told):
        b = block(rows)
        b.share(told[0])
        return b.ask_suffixes()

    shared = stored(B.answered(B.asked(blocks, keys, "keys binary, said binary"), reply_keys), "suffix-keys")
    masks = stored(B.answered(B.asked(blocks, suffixes, "n int, keys binary, ids binary, wins binary, text binary, prints binary, least binary", (shared,)), reply_suffixes), "suffix-masks")
    fields = [*docs.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", _n_bytes long, _n_removed long, _n_spans long" + ("" if replace else ", _kept binary")

    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                b = block(B.opened(batch.column("data")[k]))
                b.share(B.earlier(batch.column("answer0")[k]))
                gone = b.removed(B.earlier(batch.column("answer1")[k]))
                table, raw, offsets = b.rows, b.raw, b.offsets
                del b
                edge = gone.copy()
                starts = offsets[:-1][np.diff(offsets) > 0]
                edge[1:] &= ~gone[:-1]
                edge[starts] = gone[starts]
                total, spans = (np.searchsorted(np.flatnonzero(x), offsets) for x in (gone, edge))  # before each offset
                left = raw[~gone].tobytes()
                at = offsets - total
                kept = [left[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                extra = [np.diff(offsets), np.diff(total), np.diff(spans)]
                if replace:
                    texts = [k.decode("utf-8", "ignore") if n else t for k, n, t in zip(kept, extra[1].tolist(), table.column(text_col).to_pylist(), strict=True)]
                    at = table.column_names.index(text_col)
                    table = table.set_column(at, table.schema.field(at), pa.array(texts, table.schema.field(at).type))
                last = [] if replace else [("_kept", pa.array(kept, pa.binary()))]
                for name, values in [*zip(("_n_bytes", "_n_removed", "_n_spans"), (pa.array(x.astype(np.int64)) for x in extra), strict=True), *last]:
                    table = table.append_column(name, values)
                del gone, edge, raw, left, kept
                yield from table.to_batches()
                give_back()

    return B.joined(blocks, (shared, masks)).mapInArrow(cut, schema)


def repeats_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 of without_repeats."""
    out = without_repeats(docs.select(id_col, text_col), id_col, text_col)
    return out.select(id_col, F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
