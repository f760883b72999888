"""Language of texts: an interpolated Kneser-Ney model of letters for each language, in one sorted array of hashes."""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..scratch import small
from .common import cut_texts, give_back, mix64, small_batches, stored, text_buffer

#: Longest n-grams of letters; different texts of a language, about, that its model is fitted on, and others that
#: calibrate it; the least of them by which a limit is set.
ORDER, FIT_TEXTS, CALIBRATION_TEXTS, LEAST_TEXTS = 5, 4000, 1000, 20
#: N-grams of languages that are kept at most (the most frequent ones), and numbers that all models hold at most.
MOST_GRAMS, MOST_NUMBERS = 1_500_000, 12_000_000
#: Documents are learnt from unless crc32 of their id's digits leaves this rest.
FOLDS, HELD_OUT = 4, 2
#: Share of a language's calibration texts whose cross-entropy its limit lets pass, and the score from which an
#: answer is relied on.
WITHIN, RELIED = 0.995, 0.5
#: Bytes of text worked on at once, and words whose probabilities a task remembers.
CHUNK_BYTES, REMEMBERED = 1 << 20, 200_000
#: What calibration tries: the power of a text's length, and the weight, that turn a cross-entropy into evidence.
POWERS, WEIGHTS = (0.0, 0.25, 0.5, 0.75, 1.0), tuple(float(w) for w in np.logspace(-1.5, 2.5, 25))

#: Bytes behind which a text may be cut: ASCII that is no letter.
CUTS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
EDGE = 32  # what stands before and behind words


class Alphabet:
    """For each code point whether it is a letter, and its lower case (itself, where that is longer). Once a worker."""

    _made = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls._made is None:
            every = [chr(i) for i in range(sys.maxunicode + 1)]
            letter = np.fromiter((c.isalpha() for c in every), bool, len(every))
            lower = np.arange(len(every), dtype=np.uint32)
            for i in np.flatnonzero(letter).tolist():
                told = every[i].lower()
                if len(told) == 1:
                    lower[i] = ord(told)
            cls._made = letter, lower
        return cls._made


@dataclass
class Words:
    """The words (runs of letters, in lower case) of some texts: hashes and letters of the distinct ones, first (where
    each one's letters begin, n + 1 long), and of each word that occurs its text and which distinct one it is."""

    keys: np.ndarray
    letters: np.ndarray
    first: np.ndarray
    text: np.ndarray
    which: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, begin: np.ndarray, owner: np.ndarray) -> Words:
        """raw: parts of texts in UTF-8 with a line feed behind each; begin: where they begin; owner: their texts."""
        letter, lower = Alphabet.get()
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        begin = np.cumsum((raw & 0xC0) != 0x80)[begin] - 1  # in code points
        edge = np.diff(np.concatenate([[False], letter[points], [False]]).view(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = end - start
        cut = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(cut, size)
        told = lower[points[np.repeat(start, size) + place]].astype(np.uint64)
        value = mix64(told * np.uint64(0x9E3779B97F4A7C15) + mix64(place.astype(np.uint64)))
        keys = mix64(np.add.reduceat(value, cut) + size.astype(np.uint64)) if len(size) else value
        keys, some, which = np.unique(keys, return_index=True, return_inverse=True)
        n = size[some]
        first = np.concatenate([[0], np.cumsum(n)])
        letters = told[np.repeat(cut[some] - first[:-1], n) + np.arange(first[-1])]
        return cls(keys, letters, first, owner[np.searchsorted(begin, start, "right") - 1], which)

    def chosen(self, rows: np.ndarray) -> Words:
        """Only these of the distinct words."""
        n = np.diff(self.first)[rows]
        first = np.concatenate([[0], np.cumsum(n)])
        letters = self.letters[np.repeat(self.first[:-1][rows] - first[:-1], n) + np.arange(first[-1])]
        return Words(self.keys[rows], letters, first, self.text[:0], self.which[:0])

    def grams(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Hashes of the n-grams of each order that end at each sign of each word, 0 if it would begin before the word's
        first sign; the word of each sign, and its place. A word's signs are its letters between two edges."""
        n = np.diff(self.first)
        begin = np.cumsum(n + 2) - (n + 2)
        word = np.repeat(np.arange(len(n)), n + 2)
        place = np.arange(len(word)) - begin[word]
        signs = np.full(len(word), EDGE, np.uint64)
        signs[np.repeat(begin + 1 - self.first[:-1], n) + np.arange(self.first[-1])] = self.letters
        out, h = [], np.zeros(len(signs), np.uint64)
        for k in range(1, ORDER + 1):
            older = np.zeros(len(signs), np.uint64)
            older[k - 1 :] = signs[: len(signs) - k + 1]
            h = mix64(h * np.uint64(0xA24BAED4963EE407) + older + np.uint64(k))
            out.append(np.where(place >= k - 1, h | np.uint64(1), np.uint64(0)))
        return out, word, place


def parts_of(texts: pa.Array):
    """The words of some texts, in chunks of about CHUNK_BYTES; a longer text is in several of them."""
    raw, offsets = text_buffer(texts)
    held: list[np.ndarray] = []
    own: list[int] = []
    size = 0

    def words() -> Words:
        joined = np.concatenate([x for p in held for x in (p, np.array([10], np.uint8))])
        return Words.of(joined, np.cumsum([0] + [len(p) + 1 for p in held])[:-1], np.array(own))

    for row, a, b in cut_texts(raw, offsets, CUTS, CHUNK_BYTES):
        held.append(raw[a:b])
        own.append(row)
        size += b - a
        if size >= CHUNK_BYTES:
            yield words()
            held, own, size = [], [], 0
    if held:
        yield words()


# ---- models -----------------------------------------------------------------------------------------------
def gram_counts(texts: DataFrame) -> DataFrame:
    """Of texts (lang, text): how often (n) each language has each n-gram, with the hashes of what comes before its last
    sign (ctx) and of all behind its first (lower), and whether it begins a word (head)."""

    def made(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            lang = np.array([names.index(x) for x in langs])
            for words in parts_of(batch.column("text")):
                if not len(words.keys):
                    continue
                grams, word, place = words.grams()
                for c, name in enumerate(names):
                    times = np.bincount(words.which[lang[words.text] == c], minlength=len(words.keys))[word]
                    for k, gram in enumerate(grams, 1):
                        use = np.flatnonzero((times > 0) & (gram > 0) & (place > 0))  # the edge before a word is given
                        if not len(use):
                            continue
                        keys, some, which = np.unique(gram[use], return_index=True, return_inverse=True)
                        rows = use[some]
                        ctx, lower = (grams[k - 2][rows - 1], grams[k - 2][rows]) if k > 1 else (np.zeros(len(rows), np.uint64),) * 2
                        columns = [pa.array([name] * len(rows)), pa.array([k] * len(rows), pa.int32()), *(pa.array(x.view(np.int64)) for x in (keys, ctx, lower)), pa.array(place[rows] == k - 1), pa.array(np.bincount(which, times[use]).astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, ["lang", "k", "gram", "ctx", "lower", "head", "n"])
            give_back()

    counts = texts.mapInArrow(made, "lang string, k int, gram long, ctx long, lower long, head boolean, n long")
    return counts.groupBy("lang", "k", "gram", "ctx", "lower", "head").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """Of each n-gram of any language (keys, sorted hashes) the probability of its last sign (p) and the weight of the
    shorter context's probability where nothing known follows (back), a column a language; unknown: of a new sign."""

    langs: list[str]
    keys: np.ndarray
    p: np.ndarray
    back: np.ndarray
    unknown: np.ndarray
    power: float = 0.5
    weight: float = 1.0
    limits: np.ndarray | None = None

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The place of each n-gram, -1 if it isn't known."""
        if not len(self.keys):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        return np.where(self.keys[at] == grams, at, -1)

    def of_words(self, words: Words) -> np.ndarray:
        """log10 probability of each distinct word and its end in each language."""
        grams, word, place = words.grams()
        p = np.repeat(self.unknown[None, :], len(word), 0)
        before = np.full(len(word), -1)
        for k, gram in enumerate(grams, 1):
            at = self.find(gram)
            at[gram == 0] = -1
            if k > 1:
                context = np.concatenate([[-1], before[:-1]])
                backed = np.flatnonzero((at < 0) & (gram > 0) & (context >= 0))
                p[backed] *= self.back[context[backed]]
            known = np.flatnonzero(at >= 0)
            p[known] = self.p[at[known]]
            before = at
        told = np.log10(p)
        told[place == 0] = 0  # the edge before a word is given
        return np.add.reduceat(told, np.flatnonzero(place == 0)) if len(word) else told[:0]


def kneser_ney(counts: pa.Table, langs: list[str]) -> Models:
    """Interpolated Kneser-Ney models from n-gram counts: below the highest order an n-gram counts by how many signs
    stand before it, unless it begins a word; the discount of each order is n1 / (n1 + 2 * n2)."""
    column = {c: counts.column(c).to_numpy() for c in ("k", "gram", "ctx", "lower", "head", "n")}
    lang = np.array([langs.index(x) for x in counts.column("lang").to_pylist()], np.int64)
    width = len(langs)
    grams = {c: column[c].astype(np.int64).view(np.uint64) for c in ("gram", "ctx", "lower")}
    tables = []
    for k in range(1, ORDER + 1):
        rows = np.flatnonzero(column["k"] == k)
        keys, some, which = np.unique(grams["gram"][rows], return_index=True, return_inverse=True)
        raw = np.zeros((len(keys), width))
        raw[which, lang[rows]] = column["n"][rows]
        tables.append({"keys": keys, "raw": raw, "ctx": grams["ctx"][rows][some], "lower": grams["lower"][rows][some], "head": column["head"][rows][some]})

    def places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)

    def added(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n + 1, width))  # the last row takes what has no place
        np.add.at(out, at, values)
        return out[:n]

    unknown, below, backs = None, None, []
    for k, t in enumerate(tables, 1):
        n = len(t["keys"])
        count = t["raw"]
        if k < ORDER:
            longer = tables[k]
            before = added(places(t["keys"], longer["lower"]), (longer["raw"] > 0).astype(float), n)
            count = np.where(t["head"][:, None] | (before == 0), t["raw"], before)
        ones, twos = (count == 1).sum(0), (count == 2).sum(0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        if k == 1:
            total, kinds = count.sum(0), (count > 0).sum(0)
            back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            unknown = back / (n + 1)
            p = np.where(total > 0, np.maximum(count - discount, 0) / np.maximum(total, 1), 0) + unknown
        else:
            shorter = tables[k - 2]
            at = places(shorter["keys"], t["ctx"])
            total, kinds = added(at, count, len(shorter["keys"])), added(at, (count > 0).astype(float), len(shorter["keys"]))
            back = np.where(total > 0, np.minimum(discount * kinds / np.maximum(total, 1), 1), 1.0)
            backs.append(back)
            lower = places(shorter["keys"], t["lower"])
            under = np.where(lower[:, None] >= 0, below[lower], unknown) if len(below) else np.repeat(unknown[None, :], n, 0)
            ok = (at >= 0)[:, None]
            mine = np.where(ok & (total[at] > 0), np.maximum(count - discount, 0) / np.maximum(total[at], 1), 0) if len(total) else 0
            p = mine + np.where(ok, back[at], 1.0) * under if len(back) else under
        below = p
        t["p"] = p
    backs.append(np.ones((len(tables[-1]["keys"]), width)))
    keys = np.concatenate([t["keys"] for t in tables])
    order = np.argsort(keys)
    p, back = np.concatenate([t["p"] for t in tables]), np.concatenate(backs)
    return Models(langs, keys[order], p[order].astype(np.float32), back[order].astype(np.float32), np.asarray(unknown, np.float32))


def letter_scores(models, texts: pa.Array, memory: list) -> tuple[np.ndarray, np.ndarray]:
    """Signs of each text, and their log10 probability in each language; memory: hashes and values of known words."""
    width = len(models.langs)
    signs, total = np.zeros(len(texts)), np.zeros((len(texts), width))
    for words in parts_of(texts):
        if not len(words.which):
            continue
        if not memory:
            memory += [np.zeros(0, np.uint64), np.zeros((0, width), np.float32)]
        keys, values = memory
        at = np.minimum(np.searchsorted(keys, words.keys), max(len(keys) - 1, 0))
        new = np.flatnonzero(keys[at] != words.keys) if len(keys) else np.arange(len(words.keys))
        own = np.zeros((len(words.keys), width), np.float32)
        own[:] = values[at] if len(keys) else 0
        if len(new):
            own[new] = models.of_words(words.chosen(new))
            if len(keys) + len(new) > REMEMBERED:
                memory[:] = [words.keys, own] if len(words.keys) <= REMEMBERED else []
            else:
                both = np.concatenate([keys, words.keys[new]])
                order = np.argsort(both, kind="stable")
                memory[:] = [both[order], np.concatenate([values, own[new]])[order]]
        size = np.diff(words.first) + 1.0
        signs += np.bincount(words.text, size[words.which], len(texts))
        for c in range(width):
            total[:, c] += np.bincount(words.text, own[words.which, c], len(texts))
    return signs, total


def evidence(signs: np.ndarray, total: np.ndarray, power: float, weight: float) -> np.ndarray:
    """Posterior of each language by cross-entropies (per sign), which weigh by the length of the text."""
    z = weight * (np.maximum(signs, 1) ** power)[:, None] * total / np.maximum(signs, 1)[:, None]
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit_models(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Models:
    """Models of the languages of documents that have one and aren't held out.

    About FIT_TEXTS different whole texts of each language, drawn by a hash of the text, give its counts and about
    CALIBRATION_TEXTS others calibrate: power and weight of the least log loss, and for each language the
    cross-entropy that WITHIN of its texts keep (no limit below LEAST_TEXTS of them). Counts are made by Spark; the
    driver gets at most MOST_GRAMS of them, the most frequent ones, and as many texts' scores as calibrate.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.where(F.col(lang_col).isNotNull() & (F.crc32(ids.cast("binary")) % FOLDS != HELD_OUT)).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    shares = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    drawn = rows.where("text is not null").join(small(shares, 10_000), "lang").withColumn("_h", F.xxhash64("text"))
    place = F.pmod(F.col("_h"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("_n")
    drawn = drawn.where(place < FIT_TEXTS + CALIBRATION_TEXTS).groupBy("lang", "_h").agg(F.first("text").alias("text"))
    share = CALIBRATION_TEXTS / (FIT_TEXTS + CALIBRATION_TEXTS)
    apart = F.pmod(F.xxhash64("_h"), F.lit(1 << 20)) < int(share * (1 << 20))
    drawn = stored(drawn.select("lang", "text", apart.alias("_apart")), "language-texts")
    langs = [r["lang"] for r in drawn.select("lang").distinct().orderBy("lang").collect()]  # a row a language
    most = min(MOST_GRAMS, MOST_NUMBERS // max(len(langs), 1))
    counts = gram_counts(drawn.where("not _apart").select("lang", "text"))
    models = kneser_ney(counts.orderBy(F.col("n").desc(), "k", "gram", "lang").limit(most).toArrow(), langs)
    if not langs:
        return models

    sent = spark.sparkContext.broadcast(models)

    def scored(batches):
        for batch in batches:
            signs, total = letter_scores(sent.value, batch.column("text"), [])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(signs), pa.array(list(total), pa.list_(pa.float64()))], ["lang", "signs", "total"])

    told = drawn.where("_apart").select("lang", "text").mapInArrow(scored, "lang string, signs double, total array<double>").where("signs > 0").orderBy("lang", "signs", "total").collect()
    models.limits = np.full(len(langs), np.inf)
    if not told:
        return models
    right = np.array([langs.index(r["lang"]) for r in told])
    signs, total = np.array([r["signs"] for r in told]), np.array([r["total"] for r in told])
    every = np.arange(len(right))
    loss, models.power, models.weight = min((-float(np.log(np.maximum(evidence(signs, total, a, w)[every, right], 1e-12)).mean()), a, w) for a in POWERS for w in WEIGHTS)
    own = -total[every, right] / signs
    for c in range(len(langs)):
        if (right == c).sum() >= LEAST_TEXTS:
            models.limits[c] = np.quantile(own[right == c], WITHIN)
    return models


def languages(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, lang_pred, score, cross_entropy, rejected of whole texts, one row a row of docs.

    lang_pred: the language of the lowest cross-entropy a sign (ties: the first by name); `und`, with a score of 0, if
    the text is null or has no letter, or no language was learnt. score: its calibrated probability. rejected: no
    answer to rely on, as the score is below RELIED or the cross-entropy (log10) over the language's limit. held_out:
    crc32 of the id's digits leaves HELD_OUT; a null id is empty. No other column counts.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(models)
    id_field = docs.schema[id_col]
    id_type = to_arrow_type(id_field.dataType)

    def made(batches):
        models, memory = sent.value, []
        for batch in batches:
            n = batch.num_rows
            held = [zlib.crc32(str("" if i is None else i).encode()) % FOLDS == HELD_OUT for i in batch.column("id").to_pylist()]
            if models.langs:
                signs, total = letter_scores(models, batch.column("text"), memory)
            else:
                signs, total = np.zeros(n), np.zeros((n, 1))
            some = signs > 0
            best = total.argmax(1)
            score = np.where(some, evidence(signs, total, models.power, models.weight)[np.arange(n), best], 0.0)
            cross = -total[np.arange(n), best] / np.maximum(signs, 1)
            limits = models.limits if models.limits is not None else np.full(max(len(models.langs), 1), np.inf)
            names = [models.langs[b] if s else "und" for b, s in zip(best.tolist(), some.tolist(), strict=True)]
            rejected = ~some | (score < RELIED) | (cross > limits[best])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(id_type), pa.array(held), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(np.where(some, cross, np.nan), from_pandas=True), pa.array(rejected)],
                ["id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"],
            )
        give_back()

    kind = id_field.dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(made, f"id {kind}, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
