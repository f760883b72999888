"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import completeness


def dedup_exact(df: DataFrame, audit: Iterable[str] = ()) -> DataFrame:
    """Distinct rows, audit columns aside."""
    return df.drop(*audit).distinct()


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ties are settled by all other columns, ascending, nulls last."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def keep_most_complete(df: DataFrame, keys: list[str], date_col: str, exclude: Iterable[str] = (), skip_suffix: str = "_pncp") -> DataFrame:
    """Of each key and date the row with most columns filled."""
    score = completeness(df.columns, exclude, skip_suffix)
    return keep_first(df, [*keys, date_col], [score.desc()])


def keep_top_value(df: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """Of each key the row with the largest sum of parts; the first part null sorts last, the others count 0."""
    total = F.col(parts[0])
    for p in parts[1:]:
        total = total + F.coalesce(F.col(p), F.lit(0.0))
    return keep_first(df, keys, [total.desc_nulls_last()])
