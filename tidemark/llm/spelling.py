"""Spelling variants: words one edit apart, found by walking pairs of places of one trie level by level."""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..scratch import shared_path
from .common import cut_texts, give_back, mix64, powers, small_batches, stored, text_buffer

#: Text bytes worked on at once, distinct words that a task holds before it passes their counts on, longest word
#: (bytes) whose checksum is taken along with others'.
CHUNK_BYTES, HELD_WORDS, LONG_WORD = 1 << 20, 400_000, 64
#: Longest words (code points) that walk the trie, a level each; longer ones meet by hashes, see long_pairs().
LEVELS = 32

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Bytes behind which a text may be cut: those that are no letter, nor part of a character of several bytes.
CUTS = ~LETTER
CUTS[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def crc_table() -> np.ndarray:
    """What a byte does to a CRC-32 register (polynomial 0xEDB88320, reflected)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


CRC = crc_table()


# ---- words ------------------------------------------------------------------------------------------------
def checksums(raw: np.ndarray, start: np.ndarray, size: np.ndarray, register: np.ndarray) -> np.ndarray:
    """crc32 of each raw[start : start + size] behind what the registers have read; long ones one by one."""
    out = register.copy()
    order = np.argsort(-np.minimum(size, LONG_WORD + 1).astype(np.int16), kind="stable")
    n_long = int((size > LONG_WORD).sum())
    for k in order[:n_long].tolist():
        out[k] = zlib.crc32(raw[start[k] : start[k] + size[k]].tobytes(), int(out[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    rest = order[n_long:]
    value, at, falling = out[rest], start[rest], -size[rest]
    for j in range(int(size[rest].max(initial=0))):
        n = int(np.searchsorted(falling, -j))  # words longer than j come first
        value[:n] = CRC[(value[:n] ^ raw[at[:n] + j]) & 255] ^ (value[:n] >> 8)
    out[rest] = value
    return out ^ np.uint32(0xFFFFFFFF)


def runs(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of A-Z, a-z and U+00C0 to U+00FF, which are the characters that begin with C3."""
    inside = LETTER[raw]
    lead = np.flatnonzero(raw == 0xC3)
    inside[lead] = True
    inside[lead + 1] = True
    edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words_in(raw: np.ndarray, bounds: np.ndarray, register: np.ndarray, slips: int, least: int) -> pa.Array:
    """The words of some texts, of at least `least` code points; register: of each text, what its id and a colon leave."""
    start, end = runs(raw)
    raw = LOWER[raw]
    size = end - start
    points = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)
    length = points[end - 1] - points[start] + 1
    keep = length >= least
    start, end, size, length = start[keep], end[keep], size[keep], length[keep]
    h = checksums(raw, start, size, register[np.searchsorted(bounds, start, "right") - 1])
    slip = h % slips == 0
    cut = []
    for a, b, code, n in zip(start[slip].tolist(), end[slip].tolist(), h[slip].tolist(), length[slip].tolist(), strict=True):
        word = raw[a:b].tobytes().decode()
        if n > least:
            cut.append(word[: code % n] + word[code % n + 1 :])
    start, size = start[~slip], size[~slip]
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    data = raw[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    whole = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
    return pa.concat_arrays([whole, pa.array(cut, pa.large_string())])


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int = 97, least: int = 5, least_n: int = 3) -> DataFrame:
    """word and n of whole texts: maximal runs of letters, A-Z lowered, of `least` code points and `least_n`
    occurrences or more.

    A run loses a code point, that numbered h % its length, if slips divides h, the crc32 of '<id>:<run>' (a null id is
    empty). Null texts have no words. Tasks add up counts of a bounded number of words before they pass them on.
    """
    small_batches(docs.sparkSession)

    def made(batches):
        held: list[pa.Table] = []
        rows = 0

        def total() -> pa.Table:
            out = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": out["word"].cast(pa.string()), "n": out["n_sum"]})

        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            register = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) ^ 0xFFFFFFFF for i in batch.column("id").to_pylist()], np.uint32)
            parts: list[np.ndarray] = []
            own: list[int] = []
            size = 0

            def words() -> pa.Table:
                bounds = np.cumsum([0] + [len(p) + 1 for p in parts])  # a line feed stands between parts
                joined = np.concatenate([x for p in parts for x in (p, np.array([10], np.uint8))])
                told = words_in(joined, bounds, register[own], slips, least).value_counts()
                return pa.table({"word": told.field("values"), "n": told.field("counts")})

            for row, a, b in cut_texts(raw, offsets, CUTS, CHUNK_BYTES):
                parts.append(raw[a:b])
                own.append(row)
                size += b - a
                if size >= CHUNK_BYTES:
                    held.append(words())
                    rows += held[-1].num_rows
                    parts, own, size = [], [], 0
            if parts:
                held.append(words())
                rows += held[-1].num_rows
            if rows > HELD_WORDS:
                held = [total()]
                rows = held[0].num_rows
                if rows > HELD_WORDS // 2:
                    yield from held[0].to_batches(10_000)
                    held, rows = [], 0
                    give_back()
                held = [t.set_column(0, "word", t["word"].cast(pa.large_string())) for t in held]
        if held:
            yield from total().to_batches(10_000)
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return rows.mapInArrow(made, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


# ---- pairs ------------------------------------------------------------------------------------------------
def trie(words: DataFrame) -> str:
    """A path with the trie's places by depth: place (the letters so far), n of the word that ends there (else null),
    marks, and ways: letter and marks of each place that follows.

    marks has a bit, of 64, for each ending below a place; two places without a common bit have no ending in common.
    """
    spark = words.sparkSession
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth"))
    at = at.select("depth", "n", F.expr("left(word, depth)").alias("place"), F.expr("substring(word, depth + 1, 1)").alias("letter"), F.expr("substring(word, depth + 1)").alias("_all"), F.expr("substring(word, depth + 2)").alias("_rest"))

    def bit(text: str):
        return F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({text}), 64) AS INT))")

    ways = at.groupBy("depth", "place", "letter").agg(F.bit_or(bit("_all")).alias("own"), F.bit_or(bit("_rest")).alias("marks"), F.max(F.when(F.col("letter") == "", F.col("n"))).alias("n"))
    way = F.when(F.col("letter") != "", F.struct("letter", "marks"))
    places = ways.groupBy("depth", "place").agg(F.max("n").alias("n"), F.bit_or("own").alias("marks"), F.array_sort(F.collect_list(way)).alias("ways"))
    path = shared_path(spark, "trie")
    places.hint("rebalance", "depth").write.partitionBy("depth").parquet(path)
    return path


STATES = "x string, y string, but string"


def beginnings(places: DataFrame) -> DataFrame:
    """The first edit: from each place to two that follow it by different letters (one replaced by the other), and to
    one that follows it and itself (a letter more). Which one is x doesn't matter for replaced letters. In a run of
    a letter any of them could be the one more; the last is, so none like it (`but`) comes next."""
    ways = places.select("place", "marks", "ways", F.posexplode("ways").alias("i", "way"))
    one = ways.where(F.col("way.marks").bitwiseAND(F.col("marks")) != 0).select(F.concat("place", "way.letter").alias("x"), F.col("place").alias("y"), F.col("way.letter").alias("but"))
    two = ways.select("place", "way", F.explode(F.expr("slice(ways, i + 2, size(ways))")).alias("other")).where(F.col("way.marks").bitwiseAND(F.col("other.marks")) != 0)
    return one.unionByName(two.select(F.concat("place", "way.letter").alias("x"), F.concat("place", "other.letter").alias("y"), F.lit("").alias("but")))


def short_pairs(words: DataFrame) -> list[DataFrame]:
    """Pairs (x, n_x, y, n_y) of words of at most LEVELS code points that are one edit apart, each once.

    A state is two places of the trie that an edit has led to from one; all words that begin alike share it. At each
    level the states of the level before and the edits that begin there meet the trie's table twice, by x and by y:
    where both are words' ends, they are near; by each letter that goes on from both, both go on.
    """
    spark, path = words.sparkSession, trie(words)
    table = spark.read.schema("place string, n long, marks long, ways array<struct<letter:string,marks:long>>, depth int").parquet(path)
    deepest = table.agg(F.max("depth")).first()[0] or 0
    found, before = [], None
    for level in range(1, deepest + 1):
        states = beginnings(table.where(F.col("depth") == level - 1))
        if before is not None:
            going = before.select("x", "y", F.explode("letters").alias("c"))
            states = states.unionByName(going.select(F.concat("x", "c").alias("x"), F.concat("y", "c").alias("y"), F.lit("").alias("but")))
        letters = F.transform("ways", lambda w: w["letter"])
        near = table.where(F.col("depth").isin(level - 1, level))
        xs = near.where(F.col("depth") == level).select(F.col("place").alias("x"), F.col("n").alias("n_x"), F.col("marks").alias("_mx"), letters.alias("_lx"))
        ys = near.select(F.col("place").alias("y"), F.col("n").alias("n_y"), F.col("marks").alias("_my"), letters.alias("_ly"))
        met = states.join(xs, "x").join(ys, "y").where(F.col("_mx").bitwiseAND(F.col("_my")) != 0)
        both = F.array_remove(F.array_intersect("_lx", "_ly"), F.col("but"))
        met = met.select("x", "y", "n_x", "n_y", both.alias("letters")).where("(n_x is not null and n_y is not null) or size(letters) > 0")
        before = stored(met, f"states-{level}")
        found.append(before.where("n_x is not null and n_y is not null").select("x", "n_x", "y", "n_y"))
    return found


def long_pairs(words: DataFrame) -> DataFrame:
    """Pairs of near words of which one has over LEVELS code points, each once, exact.

    Words of LEVELS code points and more tell hashes of what each lost code point leaves of them, found from sums
    over the word. Two words of a length that are alike but for one place agree at it; a word agrees as it is with
    what a longer one leaves. Pairs that meet are compared.
    """
    told = stored(words.where(F.length("word") >= LEVELS).select("word", "n", F.monotonically_increasing_id().alias("id")), "long-words")

    def made(batches):
        for batch in batches:
            for word, i in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), strict=True):
                points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                up, down = powers(len(points) + 1)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(points + np.uint64(1)) * up[: len(points)])])
                left = mix64(sums[:-1] + (sums[-1] - sums[1:]) * down[1])
                fresh = np.concatenate([[True], points[1:] != points[:-1]])  # a run's places leave the same
                kinds = [(len(points), np.arange(len(points)), left), (len(points) - 1, np.full(int(fresh.sum()), -1), left[fresh]), (len(points), np.array([-1]), mix64(sums[-1:]))]
                for k, (size, at, key) in enumerate(kinds):
                    rows = len(key)
                    yield pa.RecordBatch.from_arrays([pa.array([i] * rows), pa.array([k] * rows, pa.int32()), pa.array([size] * rows, pa.int64()), pa.array(at, pa.int64()), pa.array(key.view(np.int64))], ["id", "kind", "size", "at", "key"])
        give_back()

    keys = stored(told.select("id", "word").mapInArrow(made, "id long, kind int, size long, at long, `key` long"), "word-keys")

    def side(kind: int, name: str) -> DataFrame:
        return keys.where(F.col("kind") == kind).select("size", "at", "key", F.col("id").alias(name))

    on = ["size", "at", "key"]
    replaced = side(0, "i").join(side(0, "j"), on).where((F.col("i") < F.col("j")) & (F.col("size") > LEVELS))
    longer = side(1, "i").join(side(2, "j"), on).where(F.col("size") + 1 > LEVELS)
    met = stored(replaced.unionByName(longer).select("i", "j").distinct(), "long-pairs")
    xs, ys = (told.select(F.col("id").alias(i), F.col("word").alias(w), F.col("n").alias(f"n_{w}")) for i, w in (("i", "x"), ("j", "y")))
    return met.join(xs, "i").join(ys, "j").where(F.levenshtein("x", "y", 1) == 1).select("x", "n_x", "y", "n_y")


def roots(ups: DataFrame) -> DataFrame:
    """word and root of words with a form (word, up): each round doubles how far up they look. n doubles with every
    form, so paths have 63 steps at most and six rounds do."""
    while True:
        further = ups.select(F.col("word").alias("up"), F.col("up").alias("_next"))
        ups = stored(ups.join(further, "up", "left").select("word", F.coalesce("_next", "up").alias("up"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if ups.where("_moved").isEmpty():
            return ups.select("word", F.col("up").alias("root"))
        ups = ups.drop("_moved")


def variant_groups(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (word, n; one row each).

    Near words differ by one inserted, deleted or replaced code point; n_near is how many there are. form: the near
    word of largest n (ties: the smallest) if that is at least twice the word's own, else null; form_n is its n. root:
    where forms lead in the end, the word itself without one. No word is left out; an empty table gives none.
    """
    words = stored(words.select("word", "n"), "words")
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    found = short_pairs(words.where(F.length("word") <= LEVELS))
    if longest > LEVELS:
        found.append(long_pairs(words))
    if not found:
        return words.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"))
    pairs = reduce(DataFrame.unionByName, found)
    sides = F.explode(F.array(F.struct(F.col("x").alias("word"), (-F.col("n_y")).alias("less"), F.col("y").alias("other")), F.struct(F.col("y").alias("word"), (-F.col("n_x")).alias("less"), F.col("x").alias("other"))))
    near = pairs.select(sides.alias("s")).groupBy("s.word").agg(F.count("*").alias("n_near"), F.min(F.struct("s.less", "s.other")).alias("best"))
    out = words.join(near, "word", "left").withColumn("_is", -F.col("best.less") >= 2 * F.col("n"))
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("_is"), F.col("best.other")).alias("form"), F.when(F.col("_is"), -F.col("best.less")).alias("form_n"))
    out = stored(out, "forms")
    root = roots(out.where("form is not null").select("word", F.col("form").alias("up")))
    return out.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
