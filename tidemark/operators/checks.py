"""Data quality: each check returns what violates it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """column and n of columns that hold nulls; one scan."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "n").where("n > 0")


def repeated_values(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without nulls that occur more than once, and how often."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def values_outside(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values besides the accepted ones and how often they occur; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)).groupBy(column).agg(F.count("*").alias("n"))


def contract_breaks(df: DataFrame, contract: T.StructType) -> list[str]:
    """How names and types differ from a declared schema; empty if they don't."""
    have, want = ({f.name: f.dataType.simpleString() for f in s} for s in (df.schema, contract))
    out = [f"missing {c}" for c in want if c not in have] + [f"unexpected {c}" for c in have if c not in want]
    return out + [f"{c} is {have[c]}, not {t}" for c, t in want.items() if c in have and have[c] != t]


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """df, or an error that names every difference from the contract."""
    if broken := contract_breaks(df, contract):
        raise ValueError("schema contract broken: " + "; ".join(broken))
    return df


def reconcile(totals: DataFrame, reference: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """keys and, of each measure, ours, theirs and the difference; keys of either side."""
    theirs = reference.select(*keys, *(F.col(m).alias(f"{m}_ref") for m in measures))
    j = totals.select(*keys, *measures).join(theirs, keys, "full_outer")
    return j.select(*keys, *(x for m in measures for x in (F.col(m), F.col(f"{m}_ref"), (F.coalesce(F.col(m), F.lit(0)) - F.coalesce(F.col(f"{m}_ref"), F.lit(0))).alias(f"{m}_diff"))))
