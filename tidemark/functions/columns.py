"""Column expressions and projections that the staging steps share."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Digits of a code and the name of its level (fixed values).
LEVELS = {2: "Capítulo", 4: "Posição", 5: "Subposição 1", 6: "Subposição 2", 7: "Item", 8: "Subitem"}


def trimmed(c: Column | str) -> Column:
    return F.trim(F.col(c) if isinstance(c, str) else c)


def blank_to_null(c: Column | str, also: str | None = None) -> Column:
    """The trimmed value; blank, or equal to also, becomes null."""
    out = F.nullif(trimmed(c), F.lit(""))
    return out if also is None else F.nullif(out, F.lit(also))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose trimmed value isn't empty; nulls drop out."""
    return df.where(trimmed(column) != "")


def without(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but these; names that aren't there are ignored."""
    return df.drop(*columns)


def harmonize_variants(df: DataFrame, columns: Iterable[str], suffix: str = "_pncp") -> DataFrame:
    """One column of each pair c, c + suffix: the first that isn't null, whichever of both exist."""
    have = set(df.columns)
    columns = list(columns)
    made = {}
    for c in columns:
        parts = [F.col(x) for x in (c, c + suffix) if x in have]
        made[c] = F.coalesce(*parts) if parts else F.lit(None)
    gone = {c + suffix for c in columns} | set(columns)
    return df.select(*(c for c in df.columns if c not in gone), *(v.alias(c) for c, v in made.items()))


def completeness(columns: Iterable[str], exclude: Iterable[str] = (), skip_suffix: str = "_pncp") -> Column:
    """How many columns of a row hold a value; excluded names and those with the suffix don't count."""
    out = {e.lower() for e in exclude}
    counted = [c for c in columns if c.lower() not in out and not c.lower().endswith(skip_suffix)]
    return reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in counted), F.lit(0))


def audited(df: DataFrame, loaded_at: datetime | str, file_column: str | None = "_metadata.file_name") -> DataFrame:
    """df with _loaded_at (one time without zone for all rows) and _source_file, by default the scanned file's name."""
    out = df.withColumn("_loaded_at", F.lit(str(loaded_at)).cast("timestamp_ntz"))
    return out if file_column is None else out.withColumn("_source_file", F.col(file_column))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def level_name(code: Column) -> Column:
    """Level of a code by its number of digits; null for other lengths."""
    n = F.length(digits_only(code))
    return reduce(lambda acc, kv: acc.when(n == kv[0], kv[1]), LEVELS.items(), F.when(F.lit(False), F.lit(None).cast("string")))


def percent(c: Column | str) -> Column:
    """Text of a percentage as a share rounded to four places; what isn't a number becomes null."""
    return F.round(trimmed(c).try_cast("double") / 100, 4)


def strict_cast(c: Column | str, kind: str) -> Column:
    """The trimmed text as kind; text that isn't one fails the job, whatever the session's ANSI setting."""
    value = trimmed(c)
    wrong = F.raise_error(F.concat(F.lit("CAST_INVALID_INPUT: not a "), F.lit(kind), F.lit(": "), value))
    return F.when(value.isNotNull() & value.try_cast(kind).isNull(), wrong).otherwise(value.try_cast(kind))


def period_key(day: Column, grain: str) -> Column:
    """ISO period of a day: yyyy-MM-dd, yyyy-MM or yyyy for the grains diario, mensal and anual."""
    return F.date_format(day, {"diario": "yyyy-MM-dd", "mensal": "yyyy-MM", "anual": "yyyy"}[grain])
