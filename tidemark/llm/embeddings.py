"""Near-duplicate embeddings: rotated binary codes, estimates with bounds that always hold, exact checks where needed."""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import join_counted, stored
from .minhash import components

#: Random rotations that means of estimates use; bits of a code that bands are drawn from, at least; members that a bucket
#: of unrelated vectors should have; share of pairs at the least cosine that may meet in no bucket. Bands, and SPREAD (the
#: width of such a mean's bound in units of 1 / sqrt(dim - 1)), miss pairs, so near_vectors uses neither.
ROTATIONS, BAND_BITS, BUCKET, MISSED = 4, 1024, 32, 0.001
SPREAD = 3.5
#: Members of a label that are compared in one piece; rows of a bin of pieces.
WHOLE_PIECE, BIN_ROWS = 8192, 8192
#: What estimates in single precision may be off by, at least, and the candidates that are computed exactly at once.
ROUNDING, AT_ONCE = 1e-4, 1 << 16


@cache
def rotations(dim: int) -> np.ndarray:
    """ROTATIONS random orthogonal matrices, or more for BAND_BITS; always the same for a dimension."""
    rng = np.random.default_rng(4242 + dim)
    out = []
    for _ in range(max(ROTATIONS, -(-BAND_BITS // dim))):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out)


def banding(largest: int, least: float, dim: int) -> tuple[int, int]:
    """(bands, bits of a band) for labels of at most largest vectors.

    A bit of two vectors at an angle differs with a chance of angle / pi. Bits grow with the logarithm of the
    label's size, so buckets of unrelated vectors stay small; bands make up for what that loses. Bands share
    the BAND_BITS bits, so with many bands somewhat more than MISSED is missed.
    """
    bits = int(min(max(math.ceil(math.log2(max(largest, 2) / BUCKET)), 4), 24, dim * ROTATIONS))
    meet = (1 - math.acos(min(max(least, -1.0), 1.0)) / math.pi) ** bits
    return (1 if meet >= 1 else math.ceil(math.log(MISSED) / math.log(1 - meet))), bits


def band_keys(bits: np.ndarray, bands: int, band_bits: int) -> np.ndarray:
    """Bucket keys from chosen bits of the codes, n x bands int64."""
    rng = np.random.default_rng(99 + bits.shape[1])
    out = np.empty((len(bits), bands), np.int64)
    weights = 1 << np.arange(band_bits, dtype=np.int64)
    for b in range(bands):
        out[:, b] = bits[:, rng.choice(bits.shape[1], band_bits, replace=False)] @ weights + (b << 32)
    return out


def encode(x: np.ndarray, first: int | None = None):
    """Unit vectors' codes: bits (n x rotations * dim) and factors <code, vector> of the first ROTATIONS. With first,
    only so many rotations are made.

    A code is the signs of the rotated vector over sqrt(dim); <code, y> / factor estimates <x, y> without bias.
    """
    dim = x.shape[1]
    rotated = (x @ rotations(dim)[:first].reshape(-1, dim).T).reshape(len(x), -1, dim)
    return (rotated > 0).reshape(len(x), -1), np.abs(rotated[:, :ROTATIONS]).sum(2) / math.sqrt(dim)


def linked(x: np.ndarray, bits: np.ndarray, factors: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y (unit vectors; bits and factors of x, of the first rotation) whose cosine is least or more.

    <code of x, rotated y> / factor estimates each cosine; only pairs whose bound reaches least are computed again in
    double precision. The bound always holds: y can be no further from x's code than x (the factor is the cosine of
    that angle) and the least cosine's angle together.
    """
    dim = x.shape[1]
    rounding = max(ROUNDING, (dim + 8) * 2.0**-24)  # a sum of dim products in single precision is off by no more
    code = np.where(bits, 1.0, -1.0).astype(np.float32) / np.float32(math.sqrt(dim))
    estimated = (code / factors[:, :1].astype(np.float32)) @ (y @ rotations(dim)[0].T).astype(np.float32).T
    f = factors[:, 0]
    furthest = np.arccos(np.clip(f, 0, 1)) + math.acos(min(max(least, -1.0), 1.0))
    i, j = np.nonzero(estimated >= ((np.cos(np.minimum(furthest, math.pi)) - rounding) / f)[:, None].astype(np.float32))
    if len(i) > AT_ONCE:  # vectors lie close: single precision tells most of them apart first
        near = x.astype(np.float32) @ y.astype(np.float32).T
        keep = near[i, j] >= np.float32(least - rounding)
        i, j = i[keep], j[keep]
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), AT_ONCE):
        keep[a : a + AT_ONCE] = np.einsum("nd,nd->n", x[i[a : a + AT_ONCE]], y[j[a : a + AT_ONCE]]) >= least
    return i[keep], j[keep]


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Links i to j join components, in place: root has one member of its component for each member, the same for all."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def near_vectors(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Links between vectors of one label with cosine least or more: id_col, n_links, component_id, kept.

    Equal vectors of a label are one node with a weight. All nodes of a label meet, so no link is missed: codes rule
    out all but some pairs (linked()). That is a label's square in cheap arithmetic, in tasks of bounded memory.

    A label is compared in pieces of WHOLE_PIECE members, pair of pieces by pair, so no task holds more than a few; a
    vector is shipped once for each piece of its label. Links are counted where they are found and join roots there
    (join_roots()): a node's root in a pair of pieces is all that goes to the components, which large-star and
    small-star join, so whatever links reach stays one component.

    Null or zero vectors, those with null or non-finite parts, and null labels link with nothing: n_links 0,
    their own component, kept. Rows with one id are separate vectors that share an id; a null id is never
    kept. Vectors of different lengths never link. Other columns are ignored; empty gives empty.
    """
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")).withColumn("row", F.monotonically_increasing_id())
    ok = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))) & F.exists("v", lambda e: e != 0)
    base = stored(base.withColumn("ok", F.coalesce(ok, F.lit(False))).withColumn("h", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64(F.lit(5), "v", "label")), "vectors")
    node = base.where("ok").groupBy("h", "h2").agg(F.min("row").alias("node"), F.min("id").alias("least_id"), F.count("*").alias("weight"))
    nodes = stored(node, "vector-nodes")

    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind = np.dtype(np.float32 if single else np.float64)

    def unit(raw: list[bytes]) -> np.ndarray:
        x = np.stack([np.frombuffer(v, kind) for v in raw]).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def coded(batches):
        for batch in batches:
            size = np.array([len(v) for v in batch.column("v")], np.int64)
            for dim in np.unique(size).tolist():
                mine = batch.take(pa.array(np.flatnonzero(size == dim)))
                flat = mine.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
                raw = [v.tobytes() for v in flat]
                bits, factors = encode(unit(raw), 1)
                yield pa.RecordBatch.from_arrays(
                    [mine.column("node"), mine.column("weight"), mine.column("label"), pa.array(raw), pa.array([b.tobytes() for b in np.packbits(bits, 1)]), pa.array(factors[:, 0])],
                    ["node", "weight", "label", "v", "code", "factor"],
                )

    own = base.join(nodes, [base["row"] == nodes["node"]]).select("node", "weight", F.col("label").cast("string").alias("label"), "v")
    codes = stored(own.mapInArrow(coded, "node long, weight long, label string, v binary, code binary, factor double"), "vector-codes")
    spread = codes.withColumn("key", F.xxhash64("label", F.length("v"))).drop("label")
    sizes = stored(spread.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key", "m", F.ceil(F.col("m") / WHOLE_PIECE).cast("int").alias("pieces")), "vector-labels")
    rows = sizes.agg(F.sum(F.col("m") * F.col("pieces"))).first()[0] or 0
    bins = max(1, -(-rows // BIN_ROWS))
    placed = join_counted(spread, sizes, "key", "m").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    # a member goes to each pair (low, high) of pieces that has its own; many small labels share a bin
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("key", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece", "node", "weight", "v", "code", "factor")
    met = met.withColumn("bin", F.pmod(F.xxhash64("key", "low", "high"), F.lit(bins)))

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, weight, piece, low, high, key, factor = (table.column(c).to_numpy() for c in ("node", "weight", "piece", "low", "high", "key", "factor"))
        order = np.lexsort((high, low, key))
        cut = np.flatnonzero(np.any([x[order][1:] != x[order][:-1] for x in (key, low, high)], axis=0)) + 1
        vectors, codes_ = (table.column(c).to_pylist() for c in ("v", "code"))
        told = []
        for group in np.split(order, cut):
            x = unit([vectors[k] for k in group])
            bits = np.unpackbits(np.stack([np.frombuffer(codes_[k], np.uint8) for k in group]), axis=1, count=x.shape[1]).astype(bool)
            factors = factor[group][:, None]
            same = low[group[0]] == high[group[0]]
            a, b = np.flatnonzero(piece[group] == low[group[0]]), np.flatnonzero(piece[group] == high[group[0]])
            links, root = np.zeros(len(group), np.int64), np.arange(len(group))
            for s in range(0, len(a), 512):
                part = a[s : s + 512]
                i, j = linked(x[part], bits[part], factors[part], x[b], least)
                i, j = part[i], b[j]
                if same:
                    once = ids[group[i]] < ids[group[j]]
                    i, j = i[once], j[once]
                np.add.at(links, i, weight[group[j]])
                np.add.at(links, j, weight[group[i]])
                join_roots(root, i, j)
            k = np.flatnonzero(links)
            told.append((ids[group[k]], links[k], ids[group[root[k]]]))
        return pa.table({c: pa.array(np.concatenate(z).astype(np.int64)) for c, z in zip(("node", "links", "root"), zip(*told, strict=True), strict=True)})

    found = stored(met.groupBy("bin").applyInArrow(compared, "node long, links long, root long"), "vector-links")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    groups = components(edges)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = nodes.join(groups, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = stored(whole, "vector-groups")
    least_ids = stored(whole.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("nodes")), "vector-components")
    told = join_counted(whole, least_ids, "component", "nodes").select("h", "h2", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = join_counted(base.where("ok").select("id", "h", "h2"), stored(told, "vector-verdicts"), ["h", "h2"], "weight").select("id", "n_links", "component_id")
    out = out.unionByName(base.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
