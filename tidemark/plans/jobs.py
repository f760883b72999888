"""Whole jobs: staging to published tables, each one declarative plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import harmonize_variants
from ..operators.dedup import dedup_exact, keep_most_complete
from ..operators.history import current, scd2
from ..operators.margins import active_margins, event_table, margin_intervals, sheet_events, succession_events
from ..operators.translator import resolve_codes, stage_suggestions
from ..sources.history_table import history, merge_history


#: Rows that one task of a history dedups and sorts.
ROWS_PER_TASK = 250_000


def by_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """df dealt by its keys to as many tasks as its rows need, so that no task grows with the input; a key stays whole."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.select(F.lit(1)).count() // rows_per_task))
    return df.repartition(parts, *keys)


def versioned(raw: DataFrame, keys: list[str], date_col: str, variants: list[str] = (), audit: list[str] = (), suffix: str = "_pncp") -> DataFrame:
    """History of raw rows: variants of columns made one, exact copies gone, of each key and date the most
    complete row, versions by date. One exchange by key serves all three steps."""
    df = harmonize_variants(raw, variants, suffix) if variants else raw
    df = by_keys(df.withColumn(date_col, df[date_col].cast("date")), keys)
    df = keep_most_complete(dedup_exact(df, audit), keys, date_col, exclude=[*keys, date_col], skip_suffix=suffix)
    return scd2(df, keys, date_col)


def merge_versions(raw: DataFrame, base: str, keys: list[str], date_col: str, run: str | None = None, variants: list[str] = (), audit: list[str] = (), suffix: str = "_pncp", buckets: int = 256) -> DataFrame:
    """The history that versioned() tells, kept as a table at base: raw rows of one more load are merged into the
    buckets of their keys, and the whole history is returned."""
    df = harmonize_variants(raw, variants, suffix) if variants else raw
    merge_history(df.withColumn(date_col, df[date_col].cast("date")), base, keys, date_col, run, audit=audit, skip_suffix=suffix, buckets=buckets)
    return history(raw.sparkSession, base)


def published(raw: DataFrame, keys: list[str], date_col: str, **options) -> DataFrame:
    """Current rows of the history."""
    return current(versioned(raw, keys, date_col, **options))


def load_versions(loads: DataFrame, keys: list[str], load_col: str, audit: list[str] = ()) -> DataFrame:
    """History by load time; every load of a key is a version."""
    return scd2(dedup_exact(loads, audit), keys, load_col, by_time=True)


def margin_marts(sheets: DataFrame, standing: DataFrame, regulations: DataFrame, prefixes: DataFrame, order: list[str]) -> dict[str, DataFrame]:
    """Margins in force of both families of regulations, from their sheets."""
    events = event_table(succession_events(sheets, order), sheet_events(standing, content_needs_margin=True), regulations)
    intervals = margin_intervals(events)
    return {family: active_margins(intervals, prefixes, family) for family in ("cics", "ciiapac")}


def translated(sheet: DataFrame) -> DataFrame:
    return resolve_codes(stage_suggestions(sheet))
