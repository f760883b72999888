"""Versioned history and validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def scd2(df: DataFrame, keys: list[str], version_col: str, by_time: bool = False) -> DataFrame:
    """df with valido_de, valido_ate and is_current.

    A version holds from its date (or load time) to a day before the next; one without a next is current. A
    null date sorts last, so beside the last dated version it is current too. Partition by the keys before
    deduplicating and one exchange serves all steps.
    """
    following = F.lead(version_col).over(Window.partitionBy(*keys).orderBy(F.col(version_col).asc_nulls_last()))
    out = df.withColumn("_next", following)
    until = F.col("_next") - F.expr("INTERVAL 1 DAY") if by_time else F.date_sub("_next", 1)
    return out.withColumns({"valido_de": F.col(version_col), "valido_ate": until, "is_current": F.col("_next").isNull()}).drop("_next")


def current(history: DataFrame) -> DataFrame:
    """Current versions, without the flag."""
    return history.where("is_current").drop("is_current")


def as_of(history: DataFrame, day: str) -> DataFrame:
    """Versions that held on a day."""
    d = F.lit(day).cast("date")
    return history.where((F.col("valido_de") <= d) & ((F.col("valido_ate") >= d) | F.col("is_current")))


def loads_as_of(history: DataFrame, moment: str, keys: list[str]) -> DataFrame:
    """Of a history by load time the version of each key that a read at a moment saw: the last one loaded by then.

    valido_ate is no bound here, as it may lie before valido_de when two loads are less than a day apart.
    """
    seen = history.where(F.col("valido_de") <= F.lit(moment).cast("timestamp_ntz"))
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("valido_de").desc(), *(F.col(c).asc_nulls_last() for c in history.columns if c not in keys)))
    return seen.withColumn("_rn", last).where("_rn = 1").drop("_rn", "valido_ate", "is_current")


def retained(df: DataFrame, loaded_col: str, now: str, days: int) -> DataFrame:
    """Rows loaded in the last days before now; what it leaves out is what retention drops."""
    return df.where(F.col(loaded_col) >= F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAY"))


def event_intervals(df: DataFrame, group: list, date: str, kind: str, opens: str) -> DataFrame:
    """Intervals from enabling and disabling events: rows of kind opens, data_inicio and data_fim.

    Events of a group are ordered by date, then kind, then all other columns; an interval ends a day before
    the next event of any kind and is open without one.
    """
    known = [date, kind]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in known]
    w = Window.partitionBy(*group).orderBy(F.col(date).asc_nulls_last(), F.col(kind).asc_nulls_last(), *rest)
    out = df.withColumn("_next", F.lead(date).over(w)).where(F.col(kind) == opens)
    return out.withColumn("data_inicio", F.col(date)).withColumn("data_fim", F.date_sub("_next", 1)).drop("_next", date, kind)


def latest_active(df: DataFrame, group: list, start: str = "data_inicio", end: str = "data_fim") -> DataFrame:
    """df with ultima (the latest start of its group) and ativa (that one, and still open)."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != start]
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(start).desc_nulls_last(), *rest))
    return df.withColumn("_rn", rn).withColumn("ultima", F.col("_rn") == 1).withColumn("ativa", (F.col("_rn") == 1) & F.col(end).isNull()).drop("_rn")
