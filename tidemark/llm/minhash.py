"""MinHash near-duplicates: banded universal-hash minima, verified links, connected components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LEAST_HOT, MOST_HOT, SMALL_SIDE, Words, give_back, join_counted, mix64, runs_of_words, small_batches, spans_of_bytes, stored, text_buffer

#: Bands and rows: two sets of similarity 0.8 share no band with a chance of (1 - 0.8**5)**32, 3 in a million.
BANDS, ROWS = 32, 5
#: Standard errors below the threshold at which a signature alone rules a pair out.
CERTAIN = 6.0
#: Members of a bucket that are compared in one piece, and rows of a bin of buckets.
PIECE, BIN_ROWS = 1024, 8192


@dataclass(frozen=True)
class Shingles:
    """Sets of hashed word runs: n words, threshold as the fraction over / under."""

    n: int = 5
    over: int = 4
    under: int = 5

    def sets(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes of each document, and their n + 1 bounds."""
        words = Words(raw, offsets, lower=True)
        runs, bounds = runs_of_words(words.hashes(), words.first, self.n)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((runs, doc))
        runs, doc = runs[order], doc[order]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
        return runs[new], np.searchsorted(doc[new], np.arange(len(bounds)))


_rng = np.random.default_rng(77)
FACTORS = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of multiply-shift hashes, n x (BANDS * ROWS) uint32; of empty sets all ones."""
    n = len(bounds) - 1
    out = np.full((n, BANDS * ROWS), 2**32 - 1, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        starts = bounds[full]
        for k in range(BANDS * ROWS):
            out[full, k] = np.minimum.reduceat(((sets * FACTORS[k] + SHIFTS[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, n x BANDS; equal keys of different bands don't meet."""
    acc = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(sig), 1), np.uint64)
    cells = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        acc = mix64(acc + cells[:, :, r])
    return acc


def sketches(docs: DataFrame, shingles: Shingles, text_col: str) -> DataFrame:
    """docs without the text, n (set size), h1, h2 (a 128-bit hash of the set), bands (array of BANDS keys; empty for no set)."""

    def made(texts: pa.Array) -> pa.Array:
        raw, offsets = text_buffer(texts)
        sizes, one, two, keys = [], [], [], []
        for a, b in spans_of_bytes(offsets):
            sets, bounds = shingles.sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            size = np.diff(bounds)
            for out, salt in ((one, 0), (two, 0x51ED270B)):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(sets ^ np.uint64(salt)))])
                out.append(total[bounds[1:]] - total[bounds[:-1]])
            sizes.append(size)
            keys.append(band_keys(signatures(sets, bounds))[size > 0].ravel())
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        at = np.concatenate([[0], np.cumsum((n > 0) * BANDS)]).astype(np.int32)
        flat = [np.concatenate(x).astype(np.uint64).view(np.int64) if x else np.zeros(0, np.int64) for x in (one, two, keys)]
        give_back()
        return pa.StructArray.from_arrays([pa.array(n), pa.array(flat[0]), pa.array(flat[1]), pa.ListArray.from_arrays(pa.array(at), pa.array(flat[2]))], names=["n", "h1", "h2", "bands"])

    udf = F.arrow_udf(made, "struct<n:bigint,h1:bigint,h2:bigint,bands:array<bigint>>")
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(*rest, udf(F.col(text_col)).alias("s")).select(*rest, "s.*")


def full_sets(docs: DataFrame, shingles: Shingles, id_col: str, text_col: str) -> DataFrame:
    """id, whole (sorted 64-bit hashes of the full set), sig (its signature), both binary."""

    def made(texts: pa.Array) -> pa.Array:
        raw, offsets = text_buffer(texts)
        whole, sig = [], []
        for a, b in spans_of_bytes(offsets):
            sets, bounds = shingles.sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            s = signatures(sets, bounds)
            whole += [sets[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            sig += [r.tobytes() for r in s]
        give_back()
        return pa.StructArray.from_arrays([pa.array(whole, pa.binary()), pa.array(sig, pa.binary())], names=["whole", "sig"])

    return docs.select(F.col(id_col).alias("id"), F.arrow_udf(made, "struct<whole:binary,sig:binary>")(F.col(text_col)).alias("s")).select("id", "s.*")


def verified(pairs: DataFrame, sets: DataFrame, shingles: Shingles) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; signatures first rule out what is far from it."""
    t = shingles.over / shingles.under
    least = t - CERTAIN * (t * (1 - t) / (BANDS * ROWS)) ** 0.5

    @F.arrow_udf("boolean")
    def alike(wa: pa.Array, sa: pa.Array, wb: pa.Array, sb: pa.Array) -> pa.Array:
        out = []
        for p, q, x, y in zip(wa, sa, wb, sb, strict=True):
            p, x = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, x))
            ok = min(len(p), len(x)) * shingles.under >= max(len(p), len(x)) * shingles.over
            if ok and (np.frombuffer(q.as_buffer(), np.uint32) == np.frombuffer(y.as_buffer(), np.uint32)).mean() >= least:
                both = len(p) + len(x) - len(np.union1d(p, x))
                ok = both * shingles.under >= (len(p) + len(x) - both) * shingles.over
            else:
                ok = False
            out.append(ok)
        return pa.array(out, pa.bool_())

    left = sets.select(F.col("id").alias("a"), F.col("whole").alias("wa"), F.col("sig").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("whole").alias("wb"), F.col("sig").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(alike("wa", "sa", "wb", "sb")).select("a", "b")


def with_least(pairs: DataFrame, n: int) -> DataFrame:
    """n pairs (a, b) at most, each with m, the least b that its a has.

    The least comes from partial aggregation; nodes with very many pairs are joined by broadcast.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    if n <= SMALL_SIDE:  # nodes are as many as pairs at most
        return pairs.join(F.broadcast(least), "a")
    return join_counted(pairs, stored(least, "least"), "a", "n")


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star: node, component (its smallest node).

    edges: a, b. Every node of an edge is returned. Each star is a written table, and no hub is gathered in one
    place (with_least).
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_least(both, 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "star")
        told = with_least(large, before[0])
        e = stored(told.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(told.select("a", F.col("m").alias("b"))).distinct(), "star")
        now = state(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def links_across(members: DataFrame, groups: DataFrame, sets: DataFrame, shingles: Shingles) -> DataFrame:
    """Links (a, b) between documents that share a bucket but no component yet.

    In each such bucket all members outside its largest component are held against all members, full set
    against full set, in pieces: no pair becomes a row unless it is a link, and of a member's links to one
    component a piece gives one. Many small buckets share a bin.
    """
    placed = members.select("key", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("c"))
    parts = placed.groupBy("key", "c").agg(F.count("*").alias("k"))
    apart = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("k").alias("m"), F.max("k").alias("most"), F.max_by("c", "k").alias("main")).where("parts > 1")
    apart = apart.select("key", "main", F.ceil(F.col("m") / PIECE).cast("int").alias("wide"), F.ceil((F.col("m") - F.col("most")) / PIECE).cast("int").alias("tall"), "m")
    apart = stored(apart, "apart")
    rows = apart.agg(F.sum(F.col("m") * F.col("tall") + F.col("m") * F.col("wide"))).first()[0] or 0
    bins = max(1, -(-rows // BIN_ROWS))
    here = join_counted(placed, apart, "key", "m")
    own_wide, own_tall = (F.pmod(F.xxhash64("rep", F.lit(n)), F.col(x)).cast("int") for n, x in ((1, "wide"), (2, "tall")))
    among = here.select("key", "rep", "c", F.lit(False).alias("minor"), own_wide.alias("w"), F.explode(F.sequence(F.lit(0), F.col("tall") - 1)).alias("t"))
    minor = here.where("c <> main").select("key", "rep", "c", F.lit(True).alias("minor"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("w"), own_tall.alias("t"))
    met = among.unionByName(minor).join(sets.select(F.col("id").alias("rep"), "whole"), "rep").withColumn("bin", F.pmod(F.xxhash64("key", "w", "t"), F.lit(bins)))

    def compared(table: pa.Table) -> pa.Table:
        key, w, t, rep, c, is_minor = (table.column(n).to_numpy() for n in ("key", "w", "t", "rep", "c", "minor"))
        is_minor = is_minor.astype(bool)
        whole = table.column("whole").to_pylist()
        order = np.lexsort((t, w, key))
        cut = np.flatnonzero(np.any([x[order][1:] != x[order][:-1] for x in (key, w, t)], axis=0)) + 1
        found = []
        for group in np.split(order, cut):
            xs, ys = group[is_minor[group]], group[~is_minor[group]]
            if not len(xs) or not len(ys):
                continue
            flat = [np.frombuffer(whole[k], np.uint64) for k in ys]
            size = np.array([len(f) for f in flat])
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            codes, flat = np.unique(np.concatenate(flat), return_inverse=True)
            for x in xs:
                mine = np.frombuffer(whole[x], np.uint64)
                at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
                marked = np.zeros(len(codes), bool)
                marked[at[codes[at] == mine]] = True
                both = np.add.reduceat(marked[flat], starts, dtype=np.int64)
                hit = np.flatnonzero((c[ys] != c[x]) & (both * shingles.under >= (len(mine) + size - both) * shingles.over))
                for y in ys[hit[np.unique(c[ys[hit]], return_index=True)[1]]]:
                    found.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        give_back()
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return met.groupBy("bin").applyInArrow(compared, "a long, b long").distinct()


def one_text_each(keyed: DataFrame, wanted: DataFrame, keys: DataFrame) -> DataFrame:
    """rep and text of rows (_id, _t, text) that are wanted (rep, _id, _t), at least one of each; keys: all (_id, _t).

    A wanted side of at most SMALL_SIDE rows is broadcast. With more, rows are shuffled by key, but of a key that very
    many rows have each task passes one text on.
    """
    on = ["_id", "_t"]
    if wanted.count() <= SMALL_SIDE:
        return keyed.join(F.broadcast(wanted), on).select("rep", "text")
    counts = stored(keys.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > LEAST_HOT), "repeated")
    hot = F.broadcast(counts.where(F.col("_n") > max(keys.count() // MOST_HOT, LEAST_HOT)).select(*on))  # MOST_HOT at most
    one = keyed.join(hot, on, "left_semi").groupBy(*on).agg(F.first("text").alias("text"))
    return keyed.join(hot, on, "left_anti").unionByName(one.select(*keyed.columns)).join(wanted, on).select("rep", "text")


def near_rows(docs: DataFrame, shingles: Shingles, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """row, id, n (set size), component (a number of the group, null without a set), component_id of each row.

    row_col: a column of distinct numbers; without one rows are numbered here. See near_groups.
    """
    small_batches(docs.sparkSession)
    text = F.col(text_col)
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text, F.lit(3)).alias("t"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"))
    rows = stored(sketches(own, shingles, "text"), "sketches")
    full, one_set = rows.where("n > 0"), ["h1", "h2", "n"]
    # a set is a node; one of its texts, found again by id and hash, stands for all
    first = F.struct(F.col("id").isNull(), "id", "row")
    reps = full.groupBy(*one_set).agg(F.min("row").alias("rep"), F.min("id").alias("least_id"), F.min_by("id", first).alias("id"), F.min_by("t", first).alias("t"), F.count("*").alias("copies"))
    reps = stored(reps, "sets")
    bands = stored(full.join(reps.select(F.col("rep").alias("row")), "row", "left_semi").select(F.col("row").alias("rep"), "bands"), "bands")
    members = bands.select("rep", F.explode("bands").alias("key"))
    shared = stored(members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "shared-keys")
    members = stored(join_counted(members, shared, "key", "m"), "buckets")
    popular = members.groupBy("rep").agg(F.sum("m").alias("met"))
    leaders = stored(members.join(popular, "rep").groupBy("key").agg(F.min("rep").alias("first"), F.max_by("rep", "met").alias("hub"), F.max("m").alias("m")), "leaders")
    pair = (F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
    tried = join_counted(members.drop("m"), leaders, "key", "m").select("rep", F.explode(F.array("first", "hub")).alias("other")).where("rep <> other").select(*pair).distinct()
    wanted = reps.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", F.coalesce("id", "t").alias("_id"), F.col("t").alias("_t"))
    keyed = own.select(F.coalesce("id", "t").alias("_id"), F.col("t").alias("_t"), "text")
    texts = one_text_each(keyed, stored(wanted, "wanted"), rows.select(F.coalesce("id", "t").alias("_id"), F.col("t").alias("_t"))).dropDuplicates(["rep"])
    sets = stored(full_sets(texts, shingles, "rep", "text"), "full-sets")
    links = stored(verified(tried, sets, shingles), "links")
    groups = stored(components(links), "components")
    late = stored(links_across(members.drop("m"), groups, sets, shingles), "late-links")
    if late.head(1):
        groups = stored(components(links.unionByName(late)), "components")
    nodes = stored(reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(*one_set, "least_id", "component", F.col("rep").alias("own"), "copies"), "nodes")
    ids = stored(nodes.where("component is not null").groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("sets")), "component-ids")
    joined = join_counted(nodes.where("component is not null"), ids, "component", "sets").select(*one_set, "component", "component_id", "copies")
    alone = nodes.where("component is null").select(*one_set, F.col("own").alias("component"), F.col("least_id").alias("component_id"), "copies")
    nodes = stored(joined.unionByName(alone), "set-groups")
    found = join_counted(full.select("row", "id", *one_set), nodes, one_set, "copies").select("row", "id", "n", "component", "component_id")
    none = rows.where("n = 0").select("row", "id", "n", F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id"))
    return found.unionByName(none)


def near_groups(docs: DataFrame, shingles: Shingles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of near-duplicate documents: id_col, n_shingles, component_id, kept.

    Two documents are linked if their shingle sets reach the threshold, confirmed on the full sets; a group is
    what links connect, component_id its smallest id, kept whether a row bears it. Equal sets are one node, so
    exact copies cost nothing more. In each bucket of a band, every member is first held against the bucket's
    smallest and against the one that meets most others; what is still apart after that is held against all
    of its bucket, so no pair that a band shows is left out and no group is expanded into all its pairs.

    A null or empty text, or one without words, links with nothing and is its own group. Every row is a document:
    rows with one id and different texts are compared each by its own text and may fall in different groups. A
    row with a null id joins its group but isn't kept unless its group has no id. Other columns are ignored; an
    empty table gives no rows.
    """
    found = near_rows(docs, shingles, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_copies(docs: DataFrame, shingles: Shingles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest id, of repeated ids one.

    Rows whose ids are null come last in their group. Texts without words are in no group and all stay. All
    columns stay, but one named _tidemark_row; an empty table stays empty.
    """
    rows = stored(docs.withColumn("_tidemark_row", F.monotonically_increasing_id()), "numbered")
    found = stored(near_rows(rows, shingles, id_col, text_col, "_tidemark_row").where("n > 0").select("row", "id", "component"), "near-rows")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("row"))
    gone = stored(found.join(first, "row", "left_anti").select(F.col("row").alias("_tidemark_row")), "near-copies")
    if gone.count() <= SMALL_SIDE:  # else both sides are shuffled by row
        gone = F.broadcast(gone)
    return rows.join(gone, "_tidemark_row", "left_anti").drop("_tidemark_row")
