"""Secret scans: fixed patterns and a linear-chain conditional random field over tokens."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, give_back, small_batches, spans_of_bytes, stored, text_buffer

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: For Spark: whether a text has a base match. What else points to secrets.
BASE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"""
MARKS = re.compile(r"(?i:passw|secret|token|api_?key)|AKIA|(?<!\S)(?=\S{0,64}[0-9])\S{12,}", re.A)
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Hash buckets of words, and labels outside, begin, inside.
BUCKETS = 4096
OUT, BEGIN, INSIDE = 0, 1, 2
NONE = BUCKETS  # the bucket of a neighbour that isn't there
#: Bytes as digits 1, capitals 2, small letters 3, others 0; the pairs of these that count as a turn.
CLASS = np.zeros(256, np.int8)
CLASS[48:58], CLASS[65:91], CLASS[97:123] = 1, 2, 3
TURN = np.zeros((4, 4), np.int32)
AT_SIGN = (np.arange(256) == 64).astype(np.int32)
TURN[1, 2:] = TURN[2:, 1] = TURN[3, 2] = 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns in code points, by start and kind.

    Runs [0-9a-f]+ and AKIA[A-Z0-9]+ of a least length are searched for as such; a shorter one never hides a
    longer one, so this finds what dropping the short ones would leave. Assignments are dropped after matching.
    """
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(found)


class Tokens(Words):
    """Words of documents with the features of the random field; lines bound its chains."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        super().__init__(raw, offsets, lower=True)
        n = len(self.start)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        size = self.end - self.start

        def inside(which: np.ndarray) -> np.ndarray:
            """How many bytes of each word are in the set."""
            total = np.zeros(len(raw) + 1, np.int32)
            np.cumsum(which[raw], out=total[1:])
            return total[self.end] - total[self.start]

        sets = np.zeros((5, 256), np.int32)
        sets[0, 48:58] = 1
        sets[1, 65:91] = 1
        sets[2, list(range(97, 103))] = 1
        sets[3, 97:123] = 1
        sets[4, [43, 47, 95, 46, 61, 45]] = 1
        digit, upper, hexes, lower, glue = (inside(s) for s in sets)
        mark = np.zeros(256, np.int32)
        mark[[58, 61]] = 1
        marks = inside(mark)
        akia = np.zeros(n, bool)
        long = np.flatnonzero(size >= 4)
        akia[long] = (raw[self.start[long]] == 65) & (raw[self.start[long] + 1] == 75) & (raw[self.start[long] + 2] == 73) & (raw[self.start[long] + 3] == 65)
        length = np.searchsorted([4, 8, 12, 16, 20, 24, 32], size, "right")
        share = np.where(digit == 0, 0, np.where(digit * 4 < size, 1, 2))
        cases = (upper > 0) * 1 + (lower > 0) * 2
        only_hex = (digit + hexes == size) & (digit > 0)
        self.shape = ((((length * 3 + share) * 4 + cases) * 2 + only_hex) * 2 + (marks > 0)) * 2 + akia
        self.shape = (self.shape * 2 + (glue > marks)).astype(np.int64)
        # what secrets of different kinds have in common: long, and changing between digits and letters, or to
        # capitals, far more often than words, numbers, dates and addresses do
        kind = CLASS[raw]
        turns = np.zeros(len(raw) + 1, np.int32)
        turns[2:] = np.cumsum(TURN[kind[:-1], kind[1:]])
        turns = turns[self.end] - turns[self.start + 1]
        often = np.where(turns == 0, 0, np.where(turns * 8 < size, 1, np.where((turns * 5 < size) | (turns < 4), 2, 3)))
        self.coarse = ((np.searchsorted([8, 12, 16], size, "right") * 4 + often) * 2 + (inside(AT_SIGN) > 0)).astype(np.int64)
        # the word up to its first : or = names what is assigned
        pos = np.flatnonzero(mark[raw])
        cut = np.concatenate([pos, [len(raw)]])[np.searchsorted(pos, self.start)] if n else np.zeros(0, np.int64)
        name_end = np.minimum(cut, self.end)
        self.name = (self.hashes(self.start, name_end) % np.uint64(BUCKETS)).astype(np.int64)
        newline = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(raw == 10, out=newline[1:])
        line = newline[self.start]
        self.chain_start = np.ones(n, bool)
        self.chain_start[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        lines = newline[offsets[1:]] - newline[offsets[:-1]]
        per_line = np.diff(self.first) // np.maximum(lines + 1, 1)
        self.file = (np.minimum(np.log2(lines + 1).astype(np.int64), 7) * 8 + np.minimum(np.log2(per_line + 1).astype(np.int64), 7))[doc]
        self.doc = doc

    def columns(self) -> np.ndarray:
        """Feature numbers of each token, one of each template."""
        n = len(self.start)
        last = np.ones(n, bool)
        last[:-1] = self.chain_start[1:]
        prev_name, prev_shape = np.full(n, NONE), np.full(n, SHAPES)
        prev_name[1:], prev_shape[1:] = self.name[:-1], self.shape[:-1]
        prev_name[self.chain_start], prev_shape[self.chain_start] = NONE, SHAPES
        next_shape = np.full(n, SHAPES)
        next_shape[:-1] = self.shape[1:]
        next_shape[last] = SHAPES
        parts = (self.shape, self.name, prev_name, prev_shape, next_shape, self.file, self.coarse)
        return np.stack([p + o for p, o in zip(parts, OFFSETS, strict=True)], 1)


SHAPES = 8 * 3 * 4 * 2 * 2 * 2 * 2
OFFSETS = np.cumsum([0, SHAPES, BUCKETS + 1, BUCKETS + 1, SHAPES + 1, SHAPES + 1, 64])
FEATURES = int(OFFSETS[-1] + 32) + 1
BLANK = FEATURES - 1  # a feature that says nothing: its weights stay 0
#: Templates that training also sees blank: what is left has to do for secrets of unknown shapes and names.
SPECIFIC = [0, 1, 2]
#: Tokens of plain chains to one value that training plants among them.
PLANTED = 50


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Field:
    """Weights of a linear-chain random field: features by label, transitions, first and last labels."""

    def __init__(self):
        self.w = np.zeros((FEATURES, 3), np.float32)
        self.t = np.zeros((3, 3))
        self.first, self.last = np.zeros(3), np.zeros(3)
        self.first[INSIDE] = self.t[OUT, INSIDE] = -20.0  # inside must follow begin or inside

    def emissions(self, columns: np.ndarray) -> np.ndarray:
        out = np.zeros((len(columns), 3))
        for k in range(columns.shape[1]):
            out += self.w[columns[:, k]]
        return out

    def fit(self, columns: np.ndarray, labels: np.ndarray, chain_start: np.ndarray, epochs: int = 30, rate: float = 1.0, decay: float = 1e-4) -> Field:
        """Maximum likelihood by full-batch AdaGrad; forward and backward run over all chains in step."""
        heads = np.flatnonzero(chain_start)
        sizes = np.diff(np.append(heads, len(labels)))
        order = np.argsort(-sizes, kind="stable")
        heads, sizes = heads[order], sizes[order]
        most = int(sizes.max()) if len(sizes) else 0
        alive = [int(np.searchsorted(-sizes, -k, "left")) for k in range(most)]  # chains longer than k
        squares = [np.full(x.shape, 1e-8) for x in (self.w, self.t, self.first, self.last)]
        gold = np.eye(3)[labels]
        tails = heads + sizes - 1
        pair = np.zeros((3, 3))
        follow = np.flatnonzero(~chain_start)
        chain = np.cumsum(chain_start) - 1
        np.add.at(pair, (labels[follow - 1], labels[follow]), 1)
        for _ in range(epochs):
            e = self.emissions(columns)
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[heads] = e[heads] + self.first
            for k in range(1, most):
                at = heads[: alive[k]] + k
                alpha[at] = e[at] + log_sum(alpha[at - 1][:, :, None] + self.t, 1)
            beta[tails] = self.last
            for k in range(most - 2, -1, -1):
                at = heads[: alive[k + 1]] + k
                beta[at] = log_sum(self.t + (e[at + 1] + beta[at + 1])[:, None, :], 2)
            z = np.empty(len(heads))
            z[order] = log_sum(alpha[tails] + self.last, 1)
            total = z[chain]
            belief = np.exp(alpha + beta - total[:, None])
            off = gold - belief
            two = np.exp(alpha[follow - 1][:, :, None] + self.t + (e[follow] + beta[follow])[:, None, :] - total[follow][:, None, None]).sum(0)
            gw = np.stack([sum(np.bincount(columns[:, k], off[:, y], FEATURES) for k in range(columns.shape[1])) for y in range(3)], 1) - decay * self.w
            gw[BLANK] = 0
            for x, g, s in zip((self.w, self.t, self.first, self.last), (gw, pair - two, off[heads].sum(0), off[tails].sum(0)), squares, strict=True):
                s += g * g
                x += (rate * g / np.sqrt(s)).astype(x.dtype)
        return self

    def decode(self, columns: np.ndarray, chain_start: np.ndarray) -> np.ndarray:
        """Viterbi labels.

        A token whose outside score beats the others by more than any transitions can win back is outside on
        every best path; chains are cut at such tokens and only the stretches between them are searched.
        """
        n = len(columns)
        labels = np.zeros(n, np.int8)
        if not n:
            return labels
        e = self.emissions(columns)
        ends = np.ones(n, bool)
        ends[:-1] = chain_start[1:]
        into = np.vstack([self.t, self.first])
        out_of = np.hstack([self.t, self.last[:, None]])
        sure = np.ones(n, bool)
        for y in (BEGIN, INSIDE):
            gain = (into[:, y] - into[:, OUT]).max() + (out_of[y] - out_of[OUT]).max()
            sure &= e[:, OUT] > e[:, y] + gain + 1e-9
        rest = np.flatnonzero(~sure)
        if not len(rest):
            return labels
        new = np.ones(len(rest), bool)
        new[1:] = (np.diff(rest) > 1) | chain_start[rest[1:]]
        heads = rest[new]
        sizes = np.diff(np.append(np.flatnonzero(new), len(rest)))
        order = np.argsort(-sizes, kind="stable")
        heads, sizes = heads[order], sizes[order]
        score = np.where(chain_start[heads][:, None], self.first, self.t[OUT]) + e[heads]
        back = [np.zeros((0, 3), np.int8)]
        alive = len(heads)
        for k in range(1, int(sizes[0])):
            alive = int(np.searchsorted(-sizes, -k, "left"))
            step = score[:alive][:, :, None] + self.t
            back.append(step.argmax(1).astype(np.int8))
            score[:alive] = step.max(1) + e[heads[:alive] + k]
        tails = heads + sizes - 1
        state = (score + np.where(ends[tails][:, None], self.last, self.t[:, OUT])).argmax(1)
        labels[tails] = state
        for k in range(int(sizes[0]) - 1, 0, -1):
            alive = int(np.searchsorted(-sizes, -k, "left"))
            state[:alive] = back[k][np.arange(alive), state[:alive]]
            labels[heads[:alive] + k - 1] = state[:alive]
        return labels


def chars_before(text: bytes, at: np.ndarray) -> np.ndarray:
    """Code points before byte positions."""
    total = np.zeros(len(text) + 1, np.int64)
    np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, out=total[1:])
    return total[at]


def spread(found: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """At most so many of them, evenly spaced."""
    return [found[i] for i in sorted({k * len(found) // most for k in range(most)})] if len(found) > most else found


def excerpts(texts: list[str], line_chars: int, windows: int, kinds: tuple[str, ...] = KINDS):
    """Of each text with words: columns, labels by the base patterns and chain starts of the tokens to learn from.

    Those are the tokens in windows around base matches and around other marks, and the first ones of the first
    three lines. All are features and labels of the whole text.
    """
    for text in texts:
        raw, offsets = text_buffer(pa.array([text], pa.string()))
        tokens = Tokens(raw, offsets)
        if not len(tokens.start):
            continue
        at, to = chars_before(raw.tobytes(), tokens.start), chars_before(raw.tobytes(), tokens.end)
        labels = np.zeros(len(at), np.uint8)
        spans = [x for x in base_spans(text) if KINDS[x[1]] in kinds]
        for s, _, e in spans:
            hit = np.arange(np.searchsorted(to, s, "right"), np.searchsorted(at, e, "left"))
            labels[hit] = np.where(labels[hit] > 0, labels[hit], INSIDE)
            labels[hit[:1]] = np.where(labels[hit[:1]] == INSIDE, BEGIN, labels[hit[:1]])
        line = np.cumsum(tokens.chain_start) - 1
        chosen = (line < 3) & (at - at[tokens.chain_start][line] < line_chars)
        others = [m.span() for m in MARKS.finditer(text)]
        for s, e in [*spread([(s, e) for s, _, e in spans], windows), *spread(others, windows)]:
            chosen[np.searchsorted(to, s - line_chars // 2, "right") : np.searchsorted(at, e + line_chars // 2, "left")] = True
        for i in np.flatnonzero(chosen[1:] & ~chosen[:-1] & (labels[1:] == INSIDE)).tolist():  # no chain starts inside
            while labels[i + 1] == INSIDE and i >= 0:
                chosen[i] = True
                i -= 1
        kept = np.flatnonzero(chosen)
        start = tokens.chain_start[kept] | (np.diff(kept, prepend=-9) > 1)
        yield tokens.columns()[kept].astype("<u2"), labels[kept], start


def planted(columns: np.ndarray, labels: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chains without secrets again, with the values of secrets (the last token of each) planted among them.

    One to PLANTED tokens, at places drawn by a fixed seed, with the neighbours and the file they then have, and
    SPECIFIC features blank. This says what the names before values hide: that a value alone is a secret
    anywhere.
    """
    chain = np.cumsum(starts) - 1
    rows = np.flatnonzero(np.bincount(chain, labels)[chain] == 0)
    values = np.flatnonzero((labels > 0) & ~np.append((labels[1:] == INSIDE) & ~starts[1:], False))
    n = len(rows) // PLANTED if len(values) else 0
    after = np.sort(np.random.default_rng(3).integers(0, len(rows), n)) + 1 if n else np.zeros(0, np.int64)
    put = np.insert(np.zeros(len(rows), bool), after, True)
    out = columns[np.insert(rows, after, np.resize(values, n))].astype(np.int64)
    first = np.insert(starts[rows], after, False)
    at = np.flatnonzero(put)
    out[at, 5] = out[at - 1, 5]
    last = np.append(first[1:], True)[: len(out)]
    out[1:, 3] = out[:-1, 0] + OFFSETS[3]
    out[:-1, 4] = out[1:, 0] + OFFSETS[4]
    out[first, 3], out[last, 4] = SHAPES + OFFSETS[3], SHAPES + OFFSETS[4]
    out[:, SPECIFIC] = BLANK
    return out, np.where(put, BEGIN, OUT), first


def train_field(docs: DataFrame, sample: int = 1500, line_chars: int = 120, id_col: str = "doc_id", text_col: str = "text", windows: int = 16, kinds: tuple[str, ...] = KINDS) -> Field:
    """Fits the field on at most sample documents with a base pattern and as many without.

    Both come first of all documents by a hash of the id: hashes alone are compared, then texts are looked up.
    Bounded by sample, line_chars and windows: of each, windows of line_chars characters around base matches and
    around other marks (if there are more, so many of each, evenly spaced) and as many characters of the first
    three lines. kinds: the base patterns that count as secrets; without one, what the field finds of it shows
    how it does on secrets of a kind that nothing names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    mark, same = F.xxhash64(F.col(id_col), F.lit(7)), F.xxhash64(text)
    keys = stored(docs.select(mark.alias("_mark"), same.alias("_same"), text.rlike(BASE).alias("_hint")), "secret-marks")
    some = [keys.where(F.col("_hint") == hint).orderBy("_mark", "_same").limit(sample).select("_mark", "_same") for hint in (True, False)]
    chosen = F.broadcast(some[0].unionByName(some[1]).distinct())

    def made(batches):
        for batch in batches:
            rows = [[x.tobytes() for x in e] for e in excerpts(batch.column("_text").to_pylist(), line_chars, windows, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in (zip(*rows, strict=True) if rows else ((), (), ()))], ["columns", "labels", "starts"])

    texts = docs.select(mark.alias("_mark"), same.alias("_same"), text.alias("_text")).join(chosen, ["_mark", "_same"]).select("_text")
    parts = sorted({tuple(bytes(x) for x in r) for r in texts.mapInArrow(made, "columns binary, labels binary, starts binary").distinct().collect()})
    columns, labels, starts = (np.frombuffer(b"".join(p[k] for p in parts), kind) for k, kind in enumerate(("<u2", np.uint8, bool)))
    columns, labels = columns.reshape(-1, len(OFFSETS)), labels.astype(np.int64)
    chain = np.cumsum(starts) - 1
    again = (np.bincount(chain, labels) > 0)[chain] | (chain % 4 == 0)  # chains with secrets, and a quarter of all
    blank = columns[again]
    blank[:, SPECIFIC] = BLANK
    copies = (columns, labels, starts), (blank, labels[again], starts[again]), planted(columns, labels, starts)
    return Field().fit(*(np.concatenate(x) for x in zip(*copies, strict=True)))


def scan(texts: pa.Array, field: Field) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in code points of each text's base and field spans, by start and kind.

    A span of the field that touches a base span is left out, as the base one stays.
    """
    raw, offsets = text_buffer(texts)
    out = []
    for a, b in spans_of_bytes(offsets):
        part = raw[offsets[a] : offsets[b]]
        tokens = Tokens(part, offsets[a : b + 1] - offsets[a])
        labels = field.decode(tokens.columns(), tokens.chain_start)
        hit = np.flatnonzero(labels)
        begins = hit[(labels[hit] == BEGIN) | (np.diff(hit, prepend=-9) > 1) | tokens.chain_start[hit]]
        by_doc: dict[int, list[int]] = {}
        for t in begins.tolist():
            by_doc.setdefault(int(tokens.doc[t]), []).append(t)
        for d in range(a, b):
            text_bytes = raw[offsets[d] : offsets[d + 1]].tobytes()
            text = text_bytes.decode()
            spans = base_spans(text)
            if d - a in by_doc:
                until = []
                for t in by_doc[d - a]:
                    k = t + 1
                    while k < len(labels) and labels[k] == INSIDE and not tokens.chain_start[k]:
                        k += 1
                    until.append(k - 1)
                shift = offsets[d] - offsets[a]
                s = chars_before(text_bytes, tokens.start[by_doc[d - a]] - shift)
                e = chars_before(text_bytes, tokens.end[until] - shift)
                spans = sorted(spans + [(x, 3, y) for x, y in zip(s.tolist(), e.tolist(), strict=True) if not any(p < y and q > x for p, _, q in spans)])
            out.append(spans)
    give_back()
    return out


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, field: Field, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """docs with out_col: array<struct<kind, start, end>>, by start and kind, code points, end exclusive.

    Kinds: assign, access and hex of the base patterns, crf of the random field (Viterbi). A null or empty
    text has none; other columns and repeated rows stay as they are, but a column named out_col is replaced; an
    empty table stays empty.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a fixed size: FEATURES x 3 floats

    def made(texts: pa.Array) -> pa.Array:
        rows = scan(texts, shared.value)
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in r] for r in rows], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return docs.withColumn(out_col, F.arrow_udf(made, SPANS)(F.col(text_col)))


def redact(docs: DataFrame, field: Field, mask: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """docs with every found span of the text replaced by mask (overlapping spans together); null stays null."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def made(texts: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), scan(texts, shared.value), strict=True):
            if spans:
                parts, at = [], 0
                for s, _, e in spans:
                    if s >= at:
                        parts += [text[at:s], mask]
                    at = max(at, e)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, F.arrow_udf(made, "string")(F.col(text_col)))
