"""Quality rules with risk-controlled cutoffs, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

# White space that parts words, symbols that are counted.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Risk: share of good documents of a stratum that all rules together may reject, and how sure that is.
RISK, CONFIDENCE = 0.01, 0.95
#: The risk of the query rule_cutoffs, at which a stratum of 113 good labels can have a cutoff (at RISK it takes 2305).
WIDE_RISK = 0.2


def with_measures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with prefix + n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (a null text is empty).

    Each costly array is a column of its own and used more than once, so it is made once a row. Repeats:
    windows of three words as (64-bit hash, place) are sorted; those beside an equal hash repeat, and their
    places in order cover min(3, distance to the next) words each.
    """
    w, win, at, text = (F.col(f"_tidemark_{c}") for c in ("words", "windows", "places", "text"))
    out = docs.withColumn("_tidemark_text", F.coalesce(F.col(text_col), F.lit("")))
    out = out.withColumn("_tidemark_words", F.array_remove(F.split(text, f"[{SPACES}]+"), ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    n = F.size(w)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    out = out.withColumns({
        prefix + "n_words": n.cast("long"),
        prefix + "word_chars": F.length(F.array_join(w, "")).cast("long"),
        prefix + "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "_tidemark_lines": lines,
        "_tidemark_windows": F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))),
    })
    lines = F.col("_tidemark_lines")

    def beside(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(win, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(win, i + 1)["h"] == x["h"], F.lit(False))

    repeated = F.filter(win, beside)
    out = out.withColumns({
        prefix + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "_tidemark_places": F.sort_array(F.transform(repeated, lambda x: x["p"])),
    })
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(at, start, lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")), lambda s: s["n"])
    return out.withColumn(prefix + "n_repeat_words", covered).drop("_tidemark_text", "_tidemark_words", "_tidemark_lines", "_tidemark_windows", "_tidemark_places")


def rule_values(prefix: str = "") -> dict[str, Column]:
    """The rules: a value of each document, larger is worse, in steps that DuckDB can tell alike."""
    c = {k: F.col(prefix + k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    some = F.greatest(c["n_words"], F.lit(1).cast("long"))
    return {
        "symbols": F.floor(c["n_symbols"] * 100 / some),
        "repeats": F.floor(c["n_repeat_words"] * 100 / some),
        "dup_lines": F.floor(c["n_dup_lines"] * 1000 / some),
        "long_words": F.floor(c["word_chars"] * 10 / some),
    }


#: The cutoffs of each rule, in the unit of its value: the value must be larger for a document to go.
CUTOFFS = {
    "symbols": tuple(range(120, 0, -5)),
    "repeats": tuple(range(98, 2, -4)),
    "dup_lines": tuple(range(96, 0, -4)),
    "long_words": tuple(range(196, 76, -5)),
}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X of Binomial(n, p), summed in logarithms from the first term up."""
    odds = math.log(p) - math.log1p(-p)
    first = n * math.log1p(-p)
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(term, s["total"])
        return F.struct(term.alias("term"), (top + F.log(F.exp(term - top) + F.exp(s["total"] - top))).alias("total"))

    return F.when(k >= n, F.lit(1.0)).otherwise(F.exp(F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda s: s["total"])))


def holdout(measured: DataFrame, labels: DataFrame, stratum: str, id_col: str = "doc_id", prefix: str = "") -> DataFrame:
    """stratum, the rules' values (_v) and _quality of each labelled document.

    Labels may be many, and their files small for their rows, so Spark's guess of their size would broadcast more
    than the driver holds: both sides are shuffled.
    """
    told = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    values = F.array(*(F.struct(F.lit(r).alias("rule"), v.alias("value"), F.lit(list(CUTOFFS[r])).cast("array<bigint>").alias("cutoffs")) for r, v in rule_values(prefix).items()))
    return measured.select(F.col(id_col).alias("_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), values.alias("_v")).join(told.hint("merge"), "_id")


def risk_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, id_col: str = "doc_id", risk: float = RISK, confidence: float = CONFIDENCE, prefix: str = "") -> DataFrame:
    """Cutoffs per stratum and rule: stratum, rule, cutoff (null: the rule rejects nothing there).

    The labelled documents are the holdout; nothing else is fitted on them. Of each stratum's good ones, k of
    n go at a cutoff. The cutoff is safe if P(Binomial(n, risk / rules) <= k) is at most (1 - confidence)
    over strata x rules: the exact (Clopper-Pearson) upper bound of its false rejection is then under its
    share of the risk, and all bounds hold at once (Bonferroni over strata and rules). Along a rule the tests
    run from the mildest cutoff down and stop at the first that fails (fixed sequence), so cutoffs need no
    correction. A cutoff is taken only if bad documents go at it too, more often than good ones.
    """
    rules = rule_values(prefix)
    held = holdout(measured, labels, stratum, id_col, prefix)
    each = held.select("stratum", "_quality", F.explode("_v").alias("v")).select("stratum", "_quality", "v.rule", "v.value", F.explode("v.cutoffs").alias("cutoff"))
    good, gone = F.col("_quality") == 1, F.col("value") > F.col("cutoff")
    counts = each.groupBy("stratum", "rule", "cutoff").agg(F.count_if(good).alias("n"), F.count_if(good & gone).alias("k"), F.count_if(~good).alias("bad"), F.count_if(~good & gone).alias("bad_k"))
    counts = stored(counts, "rule-counts")  # a row a stratum and cutoff, used three times
    strata = counts.select("stratum").distinct().agg(F.count("*").alias("strata"))
    level = (1 - confidence) / (F.greatest(F.col("strata"), F.lit(1)) * len(rules))
    tested = counts.join(F.broadcast(strata), F.lit(True)).withColumn("safe", binomial_tail(F.col("n"), F.col("k"), risk / len(rules)) <= level)
    # the first unsafe cutoff ends the sequence
    stops = tested.groupBy("stratum", "rule").agg(F.max(F.when(~F.col("safe"), F.col("cutoff"))).alias("stop"))
    useful = (F.col("bad_k") * F.col("n") > F.col("k") * F.col("bad")) & (F.col("stop").isNull() | (F.col("cutoff") > F.col("stop")))
    return tested.join(stops, ["stratum", "rule"]).groupBy("stratum", "rule").agg(F.min(F.when(useful, F.col("cutoff"))).alias("cutoff"))


def rule_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: under 50 words, or more than half of the words in repeated three-word windows. kept: not
    base_failed, and no rule's value passes its stratum's risk-controlled cutoff. A null or empty text has
    zeros and fails the base; a null stratum is the stratum ''; a stratum without enough good labels has no
    cutoffs, so only the base speaks there. Repeated rows stay; other columns are ignored; an empty table
    gives no rows.
    """
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col(text_col).alias("text"))
    measured = stored(with_measures(own, "text").drop("text"), "rule-measures")
    cutoffs = risk_cutoffs(measured, labels, "stratum", "id")
    table = stored(cutoffs.where("cutoff is not null").groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in CUTOFFS)), "rule-cutoffs")
    if table.count() <= 10_000:  # strata; else both sides are shuffled by stratum
        table = F.broadcast(table)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = F.lit(True)
    for r, v in rule_values().items():
        passes = passes & ~F.coalesce(v > F.col(f"cut_{r}"), F.lit(False))
    out = measured.join(table, "stratum", "left")
    counts = [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select(F.col("id").alias(id_col), *counts, base.alias("base_failed"), (~base & passes).alias("kept"))
