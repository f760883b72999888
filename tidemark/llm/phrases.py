"""Collocations: phrases whose words keep together, counted without loss in quotient filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.changes import surrogate_ids
from ..scratch import shared_table, small
from .common import cut_texts, give_back, mix64, small_batches, stored, text_buffer

#: Text bytes of a block, filters that one merge takes at most, and words of the longest phrases.
BLOCK_BYTES, FAN, LONGEST = 4 << 20, 256, 4
#: Rows that one ranking task takes on before the rest of its language joins it.
RANKED = 100_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAPS = ENDS.copy()
GAPS[[9, 32]] = True

WORDS = "words array<struct<lang:string,word:string,n:int>>, tokens binary"


# ---- blocks of words --------------------------------------------------------------------------------------
def words_of(parts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, A-Z lowered, and where a word stands in another piece than the one before it."""
    raw = LOWER[np.concatenate([x for p in parts for x in (p, np.array([10], np.uint8))])]
    inside = ~GAPS[raw]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(ENDS[raw], dtype=np.int32)[start]
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[inside]))), np.diff(piece, prepend=np.int32(-1)) != 0


def block_of(parts: dict[str, list[np.ndarray]]) -> tuple[list, bytes]:
    """The distinct words of a block with lang and count, and its words as numbers into them from 1, pieces apart by 0."""
    langs, words, counts, stream, base = [], [], [], [], 0
    for lang, texts in parts.items():
        told, fresh = words_of(texts)
        coded = told.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        n = len(coded.dictionary)
        langs += [lang] * n
        words.append(coded.dictionary)
        counts.append(np.bincount(codes, minlength=n))
        place = np.arange(len(codes)) + np.cumsum(fresh)
        tokens = np.zeros(len(codes) + int(fresh.sum()), np.uint32)
        tokens[place] = codes + (base + 1)
        stream.append(tokens)
        base += n
    rows = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.concat_arrays(words).cast(pa.string()), pa.array(np.concatenate(counts), pa.int32())], ["lang", "word", "n"])
    return rows, np.concatenate(stream).tobytes()


def word_blocks(docs: DataFrame, text_col: str, lang_col: str, name: str) -> DataFrame:
    """Texts as a table of blocks, bucketed by block: block, the distinct words of each lang, and the stream of words."""
    spark = docs.sparkSession
    small_batches(spark)
    arrow = to_arrow_schema(StructType.fromDDL(WORDS))

    def made(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def block() -> pa.RecordBatch:
            rows, tokens = block_of(held)
            words = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            out = pa.RecordBatch.from_arrays([words.cast(arrow.field(0).type), pa.array([tokens], pa.binary())], schema=arrow)
            give_back()
            return out

        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for row, a, b in cut_texts(raw, offsets, ENDS, BLOCK_BYTES):
                if size and size + b - a > BLOCK_BYTES:
                    yield block()
                    held, size = {}, 0
                held.setdefault(langs[row], []).append(raw[a:b].copy())
                size += b - a
        if size:
            yield block()

    table = shared_table(spark, name)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    n = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made_rows = rows.mapInArrow(made, WORDS).select(F.monotonically_increasing_id().alias("block"), "words", "tokens")
    made_rows.write.bucketBy(n, "block").option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


# ---- quotient filters -------------------------------------------------------------------------------------
class Packing:
    """n words of b bits each (b even) as one number of n * b bits, permuted: high and low limb.

    high holds the first 64 bits of the number (all, of a shorter one), low the rest. The permutation is a
    Feistel network over the two halves of the number, so it loses nothing and spreads its first bits evenly.
    """

    ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)

    def __init__(self, n: int, b: int):
        self.n, self.b = n, b
        self.half = n * b // 2
        self.high = min(n * b, 64)
        self.low = n * b - self.high
        self.mask = np.uint64((1 << self.half) - 1)

    def _mixed(self, x: np.ndarray, key: int) -> np.ndarray:
        return mix64(x + np.uint64(key)) & self.mask

    def pack(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        b, part = np.uint64(self.b), np.uint64(self.b // 2)
        if self.n == 3:
            left = (words[0] << part) | (words[1] >> part)
            right = ((words[1] & np.uint64((1 << (self.b // 2)) - 1)) << b) | words[2]
        elif self.n == 2:
            left, right = words
        else:
            left, right = (words[0] << b) | words[1], (words[2] << b) | words[3]
        for key in self.ROUNDS:
            left, right = right, left ^ self._mixed(right, key)
        # the halves as limbs: the first high bits, and what is left
        over = np.uint64(self.low)
        return (left << np.uint64(self.half - self.low)) | (right >> over), right & np.uint64((1 << self.low) - 1)

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        b, part, over = np.uint64(self.b), np.uint64(self.b // 2), np.uint64(self.low)
        own = np.uint64((1 << (self.half - self.low)) - 1)
        left, right = (high >> np.uint64(self.half - self.low)) & self.mask, ((high & own) << over) | low
        for key in reversed(self.ROUNDS):
            left, right = right ^ self._mixed(left, key), left
        word = np.uint64((1 << self.b) - 1)
        if self.n == 3:
            return [left >> part, ((left & np.uint64((1 << (self.b // 2)) - 1)) << part) | (right >> b), right & word]
        return [left, right] if self.n == 2 else [left >> b, left & word, right >> b, right & word]


def in_order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The order of numbers given as limbs; runs that are in order already cost little."""
    order = np.argsort(high, kind="stable")
    same = high[order[1:]] == high[order[:-1]]
    if low.any() and same.any():
        tied = np.zeros(len(order), bool)
        tied[1:] |= same
        tied[:-1] |= same
        rows = order[tied]
        order[tied] = rows[np.lexsort((low[rows], high[rows]))]
    return order


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in order with the sums of their counts."""
    if not len(high):
        return high, low, counts
    order = in_order(high, low)
    high, low, counts = high[order], low[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    return high[first], low[first], np.add.reduceat(counts, first)


def low_bytes(values: np.ndarray, n: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def from_bytes(data: np.ndarray, rows: int, n: int) -> np.ndarray:
    out = np.zeros((rows, 8), np.uint8)
    out[:, :n] = data.reshape(rows, n)
    return out.view("<u8").ravel().astype(np.uint64)


class CountingFilter:
    """A counting quotient filter of sorted numbers that share their first `known` bits.

    A number's next bits are its quotient, told by place: a bit for each quotient (occupied) and one for each slot
    (end of its run). What is left of it, its remainder, stands in the slot in full, so nothing is lost. A third
    bit says whether the slot counts more than one; such counts follow in the order of slots.
    """

    @staticmethod
    def quotient_bits(rows: int, width: int) -> int:
        """About the logarithm of the rows, such that whole bytes are left of width bits."""
        q = min(max(rows, 1).bit_length(), width)
        return q - (q - width) % 8 if q >= (q - width) % 8 else width % 8

    @staticmethod
    def write(p: Packing, known: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> bytes:
        width = p.high - known
        q = CountingFilter.quotient_bits(len(high), width)
        rest = np.uint64(width - q)
        quotient = ((high >> rest) & np.uint64((1 << q) - 1)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        ends = np.concatenate([quotient[1:] != quotient[:-1], [True]])
        many = counts > 1
        bits = [np.packbits(x, bitorder="little").tobytes() for x in (occupied, ends, many)]
        high_bytes = low_bytes(high & np.uint64((1 << int(rest)) - 1), int(rest) // 8)
        size = max(1, -(-int(counts.max(initial=0)).bit_length() // 8))
        return b"".join([np.array([len(high), q, size], "<u4").tobytes(), *bits, high_bytes, low_bytes(low, -(-p.low // 8)), low_bytes(counts[many], size)])

    @staticmethod
    def read(p: Packing, known: int, prefix: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        rows, q, size = (int(x) for x in raw[:12].view("<u4"))
        at = 12

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return raw[at - n : at]

        width = p.high - known
        occupied, ends, many = (np.unpackbits(take(-(-n // 8)), count=n, bitorder="little").astype(bool) for n in (1 << q, rows, rows))
        run = np.concatenate([[0], np.cumsum(ends)[:-1]])
        quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
        rest = from_bytes(take(rows * ((width - q) // 8)), rows, (width - q) // 8)
        n_low = -(-p.low // 8)
        low = from_bytes(take(rows * n_low), rows, n_low)
        counts = np.ones(rows, np.int64)
        counts[many] = from_bytes(take(int(many.sum()) * size), int(many.sum()), size)
        top = np.uint64(prefix << width) if known else np.uint64(0)
        return top | (quotient << np.uint64(width - q)) | rest, low, counts


def dealt(p: Packing, known: int, more: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray):
    """(range, filter) of sorted numbers for each range of their first known + more bits that has any."""
    ranges = (high >> np.uint64(p.high - known - more)).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(ranges)) + 1, [len(ranges)]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b > a:
            yield int(ranges[a]), CountingFilter.write(p, known + more, high[a:b], low[a:b], counts[a:b])


def phrase_counts(stream: np.ndarray, ids: np.ndarray) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """Of 2 to LONGEST words: the distinct phrases of a block, as a list of word ids for each place, and their counts.

    stream: numbers of words, 0 between pieces; ids: the id of each number, 0 for words too rare for any phrase.
    """
    word = ids[stream]
    both = (word[1:] > 0) & (word[:-1] > 0)
    at = np.flatnonzero(both)
    pairs, which, n = np.unique((word[at] << np.uint64(32)) | word[at + 1], return_inverse=True, return_counts=True)
    first, second = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
    out = [([first, second], n)]
    pair = np.zeros(len(word), np.uint64)
    pair[at] = which
    whole = both
    for step in (1, 2):  # a phrase of 3 or 4 words is two pairs that lie one or two words apart
        whole = whole[:-1] & both[step:]
        at = np.flatnonzero(whole)
        keys, n = np.unique((pair[at] << np.uint64(32)) | pair[at + step], return_counts=True)
        a, b = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out.append(([first[a], second[a], *([first[b]] if step == 2 else []), second[b]], n))
    return out


FILTERS = "group long, range long, size int, filter binary"


def frequent_phrases(blocks: DataFrame, ids: DataFrame, n_blocks: int, bits: int, least: int) -> DataFrame:
    """ids (an array of word ids) and f of all phrases of 2 to LONGEST words with f of least or more.

    Each block counts its phrases into filters of one range of permuted numbers each. Filters of a range are merged,
    FAN blocks at a time, and dealt on to narrower ranges, until all blocks have met: so a merge holds about as much
    as a block, however many there are.
    """
    packings = {n: Packing(n, bits) for n in range(2, LONGEST + 1)}
    rounds, groups = [], n_blocks
    while groups > 1 or not rounds:
        fan = min(FAN, groups)
        rounds.append((max(1, (fan - 1).bit_length()), -(-groups // FAN)))
        groups = -(-groups // FAN)
    arrow = to_arrow_schema(StructType.fromDDL(FILTERS))
    (first_bits, first_groups), later = rounds[0], rounds[1:]

    def filters(rows: list[tuple], group: list[int] | int) -> pa.RecordBatch:
        ranges, sizes, data = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([group] * len(rows), pa.int64()), pa.array(ranges, pa.int64()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], schema=arrow)

    def counted(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                told = batch.column("ids")[k].values
                of = np.zeros(batch.column("n_words")[k].as_py() + 1, np.uint64)
                of[told.field("at").to_numpy(zero_copy_only=False) + 1] = told.field("id").to_numpy(zero_copy_only=False)
                stream = np.frombuffer(batch.column("tokens")[k].as_buffer(), np.uint32)
                rows = []
                for words, n in phrase_counts(stream, of):
                    p = packings[len(words)]
                    high, low = p.pack(words)
                    order = in_order(high, low)
                    rows += [(r, p.n, f) for r, f in dealt(p, 0, first_bits, high[order], low[order], n[order])]
                if rows:
                    yield filters(rows, batch.column("group")[k].as_py())
                give_back()

    def merged(table: pa.Table, known: int):
        sizes, data, prefix = table.column("size").to_pylist(), table.column("filter").to_pylist(), table.column("range")[0].as_py()
        for n, p in packings.items():
            parts = [CountingFilter.read(p, known, prefix, d) for s, d in zip(sizes, data, strict=True) if s == n]
            if parts:
                yield p, summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    told = blocks.select("block", F.size("words").alias("n_words"), "tokens").join(ids.hint("shuffle_hash"), "block")
    out = told.select(F.pmod(F.xxhash64("block"), F.lit(first_groups)).alias("group"), "n_words", "tokens", "ids").mapInArrow(counted, FILTERS)
    known = first_bits

    def deal(known: int, more: int):
        def on(table: pa.Table) -> pa.Table:
            rows = [(r, p.n, f) for p, kept in merged(table, known) for r, f in dealt(p, known, more, *kept)]
            give_back()
            return pa.Table.from_batches([filters(rows, table.column("group")[0].as_py())])

        return on

    for more, groups in later:
        out = out.groupBy("group", "range").applyInArrow(deal(known, more), FILTERS).withColumn("group", F.pmod("group", F.lit(groups)))
        known += more

    def kept(table: pa.Table) -> pa.Table:
        ids, counts = [], []
        for p, (high, low, n) in merged(table, known):
            often = n >= least
            words = p.unpack(high[often], low[often])
            ids += np.stack(words, 1).astype(np.int64).tolist() if often.any() else []
            counts += n[often].tolist()
        give_back()
        return pa.table({"ids": pa.array(ids, pa.list_(pa.int64())), "f": pa.array(counts, pa.int64())})

    return out.groupBy("range").applyInArrow(kept, "ids array<long>, f long")


# ---- collocations -----------------------------------------------------------------------------------------
def exact(name: str) -> Column:
    """A count whose products may pass 64 bits."""
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, share: int = 80, most: int = 2000) -> DataFrame:
    """Each lang's first `most` phrases by how well their words keep together: lang, rank, phrase, a, l, r, n, score.

    Words [^\\x20\\x09]+ (A-Z lowered) of pieces between [.,;:!?\\x0A-\\x0D]; a phrase has 2 to LONGEST words of one
    piece, and occurs a times, at least `least`. Of the cuts into a first part (l times) and a rest (r times) the one
    of the lowest score floor(2000000 * a / (l + r)) counts, ties to the shortest first part. A phrase that lies in
    a longer one with `share` percent of its occurrences or more is left out, whether that one is kept or not. n: all
    words of the lang. Ranks go by score and a, falling, and the phrase's bytes.

    A null text is empty, a null lang `und`; repeated rows each count; other columns are ignored. Texts longer than a
    block are cut between pieces. No document, no row.

    Blocks tell their distinct words; words of `least` or more occurrences (no phrase can have a rarer one, nor a
    part of a phrase) get numbers, and blocks learn the numbers of their own words by a join. Phrases of such words
    are packed, permuted and counted in quotient filters, which are merged by ranges; see frequent_phrases.
    """
    spark = docs.sparkSession
    blocks = word_blocks(docs, text_col, lang_col, "word_blocks")
    words = blocks.select("block", F.posexplode("words").alias("at", "w")).select("block", "at", "w.*")
    known = stored(words.groupBy("lang", "word").agg(F.sum("n").cast("long").alias("f")), "words")
    totals = known.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = stored(surrogate_ids(known.where(F.col("f") >= least), [F.col("lang"), F.col("word")]), "vocabulary")
    n_words, n_blocks = vocabulary.count(), blocks.count()
    bits = max(16, (n_words + 1).bit_length())
    bits += bits % 2
    if bits > 32:
        raise ValueError(f"{n_words} frequent words don't fit into 32 bits")
    own = words.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).groupBy("block").agg(F.collect_list(F.struct("at", "id")).alias("ids"))
    found = stored(frequent_phrases(blocks, own, max(n_blocks, 1), bits, least), "phrases")

    single = vocabulary.select(F.array("id").alias("ids"), "f")
    parts = found.unionByName(single)
    cuts = found.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.join(parts.select(F.col("ids").alias("_first"), F.col("f").alias("l")), F.slice("ids", 1, F.col("k")) == F.col("_first"))
    cuts = cuts.join(parts.select(F.col("ids").alias("_rest"), F.col("f").alias("r")), F.slice("ids", F.col("k") + 1, F.size("ids")) == F.col("_rest"))
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    best = cuts.groupBy("ids").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # what lies in a longer phrase: its inner parts of two words and more, with the occurrences of the most frequent one
    longer = found.where(F.size("ids") > 2).select(F.col("f"), F.explode(F.expr("flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))")).alias("ids"))
    inner = longer.groupBy("ids").agg(F.max("f").alias("_longer"))
    scored = best.join(inner, "ids", "left").where(F.col("_longer").isNull() | (exact("_longer") * 100 < exact("a") * share))

    spelled = scored.select("a", "cut.*", F.posexplode("ids").alias("at", "id"), F.col("ids").alias("_ids")).join(vocabulary.select("id", "lang", "word"), "id")
    rows = spelled.groupBy("_ids", "lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"), *(F.first(c).alias(c) for c in ("a", "l", "r", "score")))
    rows = stored(rows.drop("_ids"), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salts = max(1, rows.count() // RANKED)
    near = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order))).where(F.col("_rn") <= most).drop("_rn")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.join(small(totals, RANKED), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
