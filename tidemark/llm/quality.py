"""Quality classifier: document evidence combined with empirical-Bayes site and path rates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, give_back, join_counted, small_batches, spans_of_bytes, stored, text_buffer

HEADS = ("low", "toxic")
#: Groups (a site, a path and two numbers each) that may be broadcast.
MOST_BROADCAST = 50_000
#: Hash buckets of words; then come the bins of the shape features.
BUCKETS = 1 << 18
BINS = 12
SHAPE_NAMES = ("symbols", "capitals", "digits", "bangs", "pipes", "distinct", "length", "line_words", "stops", "size")
FEATURES = BUCKETS + BINS * len(SHAPE_NAMES)


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of documents and the n + 1 bounds: the distinct lower-cased words without their edge
    marks, hashed, and one bin of each shape."""
    w = Words(raw, offsets, lower=True)
    n = len(offsets) - 1
    edge = np.zeros(256, bool)
    edge[[33, 34, 39, 40, 41, 44, 46, 58, 59, 63, 42, 38, 35, 36, 37]] = True
    start, end = w.start.copy(), w.end.copy()
    for _ in range(3):
        start += edge[raw[start]] & (end - start > 1) if len(start) else 0
        end -= edge[raw[end - 1]] & (end - start > 1) if len(end) else 0
    doc = np.repeat(np.arange(n), np.diff(w.first))
    bucket = (w.hashes(start, end) % np.uint64(BUCKETS)).astype(np.int64)
    pairs = np.unique(doc * BUCKETS + bucket)
    words = np.maximum(np.diff(w.first), 1)
    size = np.maximum(np.diff(offsets), 1)

    def share(codes: list[int]) -> np.ndarray:
        which = np.zeros(256, np.int64)
        which[codes] = 1
        total = np.concatenate([[0], np.cumsum(which[raw])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    lines = share([10]) * size + 1
    values = (share([ord(c) for c in "#*$%&<>"]) * 40, share(list(range(65, 91))) * 12, share(list(range(48, 58))) * 40, share([33]) * 40, share([124]) * 40,
              np.bincount(pairs // BUCKETS, minlength=n) / words * 11, (size / words - 1) * 0.8, np.log2(words / lines + 1), share([46, 63]) * 200, np.log2(words + 1) * 0.8)
    shapes = np.stack([np.clip(np.ceil(v), 0, BINS - 1).astype(np.int64) + BUCKETS + k * BINS for k, v in enumerate(values)], 1) if n else np.zeros((0, 0), np.int64)
    counts = np.bincount(pairs // BUCKETS, minlength=n) + len(values)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(bounds[-1], np.int64)
    at = bounds[1:, None] - len(values) + np.arange(len(values))
    out[at] = shapes
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[rest] = pairs % BUCKETS
    return out, bounds


@dataclass
class Evidence:
    """Log likelihood ratios of the heads: a weight of each feature, and a constant."""

    weights: np.ndarray
    constant: np.ndarray

    def ratios(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        f, bounds = features(raw, offsets)
        total = np.vstack([np.zeros(2), np.cumsum(self.weights[f].astype(np.float64), 0)])
        return total[bounds[1:]] - total[bounds[:-1]] + self.constant


def fit_evidence(texts: list[str], labels: np.ndarray, least: int = 6, surprise: float = 3.0, epochs: int = 40, ridge: float = 1.0) -> Evidence:
    """Two logistic regressions on the features whose share differs between the classes.

    labels: n x 2 of 0 and 1 (low quality, toxic). A feature counts if least documents have it and its log
    odds ratio lies surprise standard errors from 0. The sample's own class ratio is taken out of the constant.
    """
    raw, offsets = text_buffer(pa.array(texts, pa.string()))
    parts = [features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in spans_of_bytes(offsets)]
    f = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), np.concatenate([np.diff(p[1]) for p in parts]) if parts else 0)
    weights, constant = np.zeros((FEATURES, 2), np.float32), np.zeros(2)
    for h in range(2):
        y = labels[:, h].astype(np.float64)
        bad, good = y.sum(), (1 - y).sum()
        if not bad or not good:
            continue
        one, zero = np.bincount(f, y[row], FEATURES), np.bincount(f, 1 - y[row], FEATURES)
        odds = np.log((one + 0.5) / (bad - one + 0.5)) - np.log((zero + 0.5) / (good - zero + 0.5))
        error = np.sqrt(1 / (one + 0.5) + 1 / (bad - one + 0.5) + 1 / (zero + 0.5) + 1 / (good - zero + 0.5))
        use = np.flatnonzero((one + zero >= least) & (np.abs(odds) > surprise * error))
        number = np.full(FEATURES, -1)
        number[use] = np.arange(len(use))
        hit = number[f] >= 0
        col, r = number[f[hit]], row[hit]
        balance = np.where(y == 1, 0.5 / bad, 0.5 / good) * len(y)  # both classes weigh the same
        w, b = np.zeros(len(use)), 0.0
        sw, sb = np.full(len(use), 1e-8), 1e-8
        for _ in range(epochs * 4):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[col], len(y)) + b, -30, 30)))
            off = (y - p) * balance
            gw, gb = np.bincount(col, off[r], len(use)) - ridge * w, off.sum()
            sw, sb = sw + gw * gw, sb + gb * gb
            w, b = w + 0.5 * gw / np.sqrt(sw), b + 0.5 * gb / np.sqrt(sb)
        weights[use, h], constant[h] = w, b
    return Evidence(weights, constant)


def sampled(labels: DataFrame, sample: int) -> DataFrame:
    """At most sample ids of each class (clean, low, toxic), first by a hash: _id, low, toxic."""
    told = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.coalesce(1 - F.col("quality"), F.lit(0))).alias("low"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    classes = ((F.col("low") == 0) & (F.col("toxic") == 0), F.col("low") == 1, (F.col("low") == 0) & (F.col("toxic") == 1))
    clean, low, toxic = (told.where(c).orderBy(F.xxhash64("_id", F.lit(9)), "_id").limit(sample) for c in classes)
    return clean.unionByName(low).unionByName(toxic)


def train(docs: DataFrame, labels: DataFrame, sample: int = 2500, id_col: str = "doc_id", text_col: str = "text", max_chars: int = 40_000) -> Evidence:
    """Evidence fitted on at most sample documents of each class, first by a hash of the id.

    Longer texts than max_chars are not used for fitting; scoring reads whole texts.
    """
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where(F.length("text") <= max_chars)
    # 3 x sample ids at most, one text of each: the least of those that share an id
    rows = own.join(F.broadcast(sampled(labels, sample)), "_id").groupBy("_id", "low", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["_id"], r["text"]))
    return fit_evidence([r["text"] for r in rows], np.array([[r["low"], r["toxic"]] for r in rows], np.int64).reshape(-1, 2))


def evidence_column(docs: DataFrame, evidence: Evidence, text_col: str = "text"):
    """struct<low double, toxic double>: log likelihood ratios of a text; 0 for a null or empty one."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(evidence)  # FEATURES x 2 floats

    def made(texts: pa.Array) -> pa.Array:
        raw, offsets = text_buffer(texts)
        parts = [shared.value.ratios(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in spans_of_bytes(offsets)]
        r = np.concatenate(parts) if parts else np.zeros((0, 2))
        r[np.diff(offsets) == 0] = 0
        give_back()
        return pa.StructArray.from_arrays([pa.array(r[:, 0]), pa.array(r[:, 1])], names=list(HEADS))

    return F.arrow_udf(made, "struct<low:double,toxic:double>")(F.col(text_col))


def logit(p):
    return F.log(p / (1 - p))


def probability(log_odds):
    return 1 / (1 + F.exp(-F.greatest(F.least(log_odds, F.lit(500.0)), F.lit(-500.0))))


def moments(rates: DataFrame, value: str, about, count: str, rate: float) -> float:
    """Prior weight from the spread of group rates beyond what counting explains (method of moments)."""
    r = rates.agg(F.sum(F.col(count)).alias("n"), F.count("*").alias("k"), F.sum(F.col(count) * (F.col(value) - about) ** 2).alias("s")).first()
    within = rate * (1 - rate)
    if not r["n"] or r["k"] < 2 or within <= 0:
        return 1e6
    between = (r["s"] - r["k"] * within) / r["n"]
    return float(min(max(within / between - 1, 1.0), 1e6)) if between > 0 else 1e6


@dataclass
class Prior:
    """What a head's groups shrink toward: the rate of all documents, and the weights of the priors."""

    rate: float
    site: float
    path: float


def hierarchy(scored: DataFrame) -> tuple[DataFrame, dict[str, Prior]]:
    """Sums of every (site, path), and the priors of the heads.

    scored: _site, _path (nulls are a group of their own) and p_low, p_toxic, the probability of each head by the
    evidence under the base rate. Columns: _site, _path, n, site_n, and low, toxic, site_low, site_toxic (sums of
    probabilities). Weights come from the method of moments; all sums are grouped aggregation, only a few numbers
    of each head reach the driver.
    """
    paths = stored(scored.groupBy("_site", "_path").agg(F.count("*").alias("n"), *(F.sum(f"p_{h}").alias(h) for h in HEADS)), "quality-paths")
    sites = paths.groupBy("_site").agg(F.sum("n").alias("site_n"), *(F.sum(h).alias(f"site_{h}") for h in HEADS))
    whole = paths.agg(F.sum("n").alias("n"), *(F.sum(h).alias(h) for h in HEADS)).first()
    both = stored(paths.join(sites, paths["_site"].eqNullSafe(sites["_site"])).drop(sites["_site"]), "quality-groups")
    priors = {}
    for h in HEADS:
        rate = min(max((whole[h] or 0.0) / max(whole["n"] or 1, 1), 1e-6), 1 - 1e-6)
        at_sites = moments(sites.withColumn("_r", F.col(f"site_{h}") / F.col("site_n")), "_r", F.lit(rate), "site_n", rate)
        at_paths = moments(both.withColumn("_r", F.col(h) / F.col("n")), "_r", F.col(f"site_{h}") / F.col("site_n"), "n", rate)
        priors[h] = Prior(rate, at_sites, at_paths)
    return both, priors


def shrunken(head: str, prior: Prior):
    """A document's rate of its site and path: what the others there show, shrunk toward the site, and that
    toward all. The document itself is left out, as its evidence comes in besides."""
    own = F.col(f"p_{head}")
    site = (F.greatest(F.col(f"site_{head}") - own, F.lit(0.0)) + prior.site * prior.rate) / (F.col("site_n") - 1 + prior.site)
    rate = (F.greatest(F.col(head) - own, F.lit(0.0)) + prior.path * site) / (F.col("n") - 1 + prior.path)
    return F.least(F.greatest(rate, F.lit(1e-9)), F.lit(1 - 1e-9))


@dataclass
class Judge:
    """Everything that a verdict needs: evidence, base rates and cutoffs of the posteriors."""

    evidence: Evidence
    base: dict[str, float]
    cutoffs: dict[str, float]


def fit_judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", low_cutoff: float = 0.25, toxic_cutoff: float = 0.15) -> Judge:
    """Evidence from a bounded labelled sample, base rates from all labels that aren't null."""
    r = labels.agg(F.count("quality").alias("n_low"), F.sum(1 - F.col("quality")).alias("low"), F.count("toxic").alias("n_toxic"), F.sum("toxic").alias("toxic")).first()
    base = {h: ((r[h] or 0) + 1) / (r[f"n_{h}"] + 4) for h in HEADS}
    return Judge(train(docs, labels, id_col=id_col, text_col=text_col), base, {"low": low_cutoff, "toxic": toxic_cutoff})


def judged(docs: DataFrame, judge: Judge, site: str = "source", path: str = "lang", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """docs (or these columns of it) with _low, _toxic (posterior probabilities of the heads) and _kept.

    The evidence of a text meets the shrunken rate that the other documents of its site and path show; _kept is
    false if either posterior passes its cutoff. Null or empty texts have no evidence, so only that rate counts;
    null sites and paths are groups of their own. Every row of docs stays, and every column but those named
    _low, _toxic and _kept, which are replaced; an empty table stays empty. Texts are read once: the columns are
    written beside their evidence.
    """
    given = [c for c in (columns if columns is not None else docs.columns) if c not in ("_low", "_toxic", "_kept")]
    llr = evidence_column(docs, judge.evidence, text_col)
    kept = docs.select(F.struct(*given).alias("row"), F.col(site).alias("_site"), F.col(path).alias("_path"), llr.alias("_evidence"))
    start = {h: float(np.log(judge.base[h] / (1 - judge.base[h]))) for h in HEADS}
    scored = stored(kept.select("row", "_site", "_path", *(F.col(f"_evidence.{h}").alias(f"e_{h}") for h in HEADS), *(probability(F.col(f"_evidence.{h}") + start[h]).alias(f"p_{h}") for h in HEADS)), "quality-evidence")
    groups, priors = hierarchy(scored)
    # nulls are equal to nulls here, so keys are never null
    key = [F.struct("_site", "_path")]
    sums = groups.select(*(k.alias("_group") for k in key), "n", "site_n", *HEADS, *(f"site_{h}" for h in HEADS))
    if sums.count() <= MOST_BROADCAST:  # else hot groups are broadcast, the rest is shuffled
        joined = scored.withColumn("_group", key[0]).join(F.broadcast(sums), "_group")
    else:
        joined = join_counted(scored.withColumn("_group", key[0]), sums.withColumn("rows", F.col("n")), "_group", "rows")
    posterior = {h: probability(F.col(f"e_{h}") + logit(shrunken(h, priors[h]))).alias(f"_{h}") for h in HEADS}
    out = joined.select("row", *posterior.values()).select("row.*", *(f"_{h}" for h in HEADS))
    return out.withColumn("_kept", (F.col("_low") < judge.cutoffs["low"]) & (F.col("_toxic") < judge.cutoffs["toxic"]))
