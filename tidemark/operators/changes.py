"""Change detection: manifests by content hash, snapshots by row, expected periods, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.columns import period_key
from ..scratch import small, stored

# What a run can find of a key.
NEW, CHANGED, SAME, ABSENT = "baixado", "atualizado", "ignorado", "indisponivel"


def manifest_diff(expected: DataFrame, observed: DataFrame, manifest: DataFrame, keys: list[str], hash_col: str = "hash_sha256", present_col: str | None = None) -> DataFrame:
    """keys, hash and status of every expected key.

    Without content it is absent; without a manifest entry new; with another hash, or if present_col of the
    manifest says that the object is missing, changed; else the same.
    """
    seen = observed.select(*keys, F.col(hash_col).alias("_seen"))
    cols = [F.col(hash_col).alias("_known"), F.lit(True).alias("_listed")] + ([F.col(present_col).alias("_present")] if present_col else [F.lit(True).alias("_present")])
    j = expected.select(*keys).join(seen, keys, "left").join(manifest.select(*keys, *cols), keys, "left")
    status = F.when(F.col("_seen").isNull(), ABSENT).when(F.col("_listed").isNull(), NEW).when(F.col("_seen").eqNullSafe(F.col("_known")) & F.coalesce("_present", F.lit(True)), SAME).otherwise(CHANGED)
    return j.select(*keys, F.coalesce("_seen", "_known").alias(hash_col), status.alias("status"))


def change_list(diff: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are new or changed."""
    return diff.where(F.col("status").isin(NEW, CHANGED)).select(*keys)


def status_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("n"))


def value_print(column: Column, kind: T.DataType) -> list[Column]:
    """What to hash of a value so that equal values, and only they, agree: xxhash64 passes over nulls wherever they
    stand, and knows no maps. Elements of arrays and entries of maps, these in the order of their hashes, are hashed
    one by one."""
    if isinstance(kind, T.StructType):
        return [column.isNull(), *(x for f in kind for x in value_print(column[f.name], f.dataType))]
    if isinstance(kind, T.ArrayType):
        each = F.transform(column, lambda x: F.xxhash64(*value_print(x, kind.elementType)))
        return [F.coalesce(F.size(column), F.lit(-1)), each]
    if isinstance(kind, T.MapType):
        each = F.transform(F.map_entries(column), lambda e: F.xxhash64(*value_print(e["key"], kind.keyType), *value_print(e["value"], kind.valueType)))
        return [F.coalesce(F.size(column), F.lit(-1)), F.array_sort(each)]
    return [column.isNull(), column]


def row_print(schema: T.StructType, *before: Column) -> Column:
    """A 64-bit hash of a row's columns."""
    return F.xxhash64(*before, *(x for f in schema for x in value_print(F.col(f"`{f.name}`"), f.dataType)))


def prints(schema: T.StructType) -> list[Column]:
    """Aggregates that tell tables (or groups) apart: rows and two order-independent hashes."""
    return [F.count("*"), F.sum(row_print(schema).cast("decimal(38,0)")), F.bit_xor(row_print(schema, F.lit(1)))]


def table_print(df: DataFrame) -> tuple:
    """Rows and hashes of a whole table: equal tables have equal ones, nulls and their places counted."""
    return tuple(df.agg(*prints(df.schema)).first())


def comparable(column: Column, kind: T.DataType) -> Column:
    """The value with maps, which can't be compared, as their entries in the order of their keys."""
    if not has_map(kind):
        return column
    if isinstance(kind, T.StructType):
        inner = F.struct(*(comparable(column[f.name], f.dataType).alias(f.name) for f in kind))
        return F.when(column.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: comparable(x, kind.elementType))
    entries = F.transform(F.map_entries(column), lambda e: F.struct(comparable(e["key"], kind.keyType).alias("k"), comparable(e["value"], kind.valueType).alias("v")))
    return F.array_sort(entries)


def has_map(kind: T.DataType) -> bool:
    inner = [f.dataType for f in kind] if isinstance(kind, T.StructType) else [kind.elementType] if isinstance(kind, T.ArrayType) else []
    return isinstance(kind, T.MapType) or any(map(has_map, inner))


def snapshot_diff(new: DataFrame, old: DataFrame | None, keys: list[str], whole_first: bool = False) -> DataFrame:
    """Rows of new whose key is new or whose content differs; deletions aren't told, no old means all rows.

    Rows are compared field by field, nulls (and NaN) being equal, so a value that moves between columns is seen; maps
    are equal if their entries are, in any order. whole_first compares table hashes before any join.
    """
    if old is None:
        return new
    if whole_first and table_print(new) == table_print(old.select(*new.columns)):
        return new.limit(0)
    rest = [f for f in new.schema if f.name not in keys]

    def content(df: DataFrame) -> Column:
        return F.struct(*(comparable(df[f.name], f.dataType).alias(f.name) for f in rest), F.lit(0).alias("_"))

    before = old.select(*keys, content(old).alias("_old"), F.lit(True).alias("_had"))
    j = new.withColumn("_new", content(new)).join(before, keys, "left")
    return j.where(F.col("_had").isNull() | ~F.col("_new").eqNullSafe(F.col("_old"))).select(*new.columns)


def period_calendar(spark: SparkSession, start: str, end: str, grains: tuple[str, ...] = ("diario", "mensal", "anual"), last_open: bool = False) -> DataFrame:
    """granularidade and periodo of every day, month and year from start to end; last_open leaves the last
    month and year, which still run, out."""
    out = None
    for g in grains:
        unit = {"diario": "DAY", "mensal": "MONTH", "anual": "YEAR"}[g]
        trunc = {"diario": "DD", "mensal": "MM", "anual": "YEAR"}[g]
        one = spark.range(1).select(F.explode(F.expr(f"sequence(CAST(date_trunc('{trunc}', DATE'{start}') AS DATE), DATE'{end}', INTERVAL 1 {unit})")).alias("d"))
        if last_open and g != "diario":
            one = one.where(F.col("d") < F.expr(f"CAST(date_trunc('{trunc}', DATE'{end}') AS DATE)"))
        one = one.select(F.lit(g).alias("granularidade"), period_key(F.col("d"), g).alias("periodo"))
        out = one if out is None else out.unionByName(one)
    return out


def latest_by(df: DataFrame, value: str, order: str, keys: list[str] | None = None) -> DataFrame:
    """The value of the latest entry, of each key if there are keys; of equal times the larger value."""
    agg = F.max(F.struct(order, value))[value].alias(value)
    return df.groupBy(*(keys or [])).agg(agg) if keys else df.agg(agg)


def content_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of the JSON of the fields, in the order given; leave out what doesn't count."""
    return F.sha2(F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))), 256)


def document_change(entries: DataFrame, document: DataFrame, hash_col: str = "hash", time_col: str = "extraido_em", keys: list[str] | None = None) -> DataFrame:
    """document with mudou: whether its hash differs from the latest entry's (or there is none)."""
    keys = keys or []
    last = latest_by(entries, hash_col, time_col, keys).withColumnRenamed(hash_col, "_last")
    joined = document.join(small(last, 100_000), keys, "left") if keys else document.join(F.broadcast(last), F.lit(True), "left")  # one row
    return joined.withColumn("mudou", ~F.col(hash_col).eqNullSafe(F.col("_last"))).drop("_last")


def surrogate_ids(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """df with consecutive numbers from 1 in the given order, which must be total.

    The table is sorted into ranges and written once with each row's place in its range; its number is that plus
    the sizes of the ranges before: one shuffle, and a few numbers meet, never the rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id counts rows within a partition and has the partition's number in its high bits
    ranged = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumns({"_part": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = before.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # one row a range
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_place") + F.col("_before") + 1).drop("_at", "_part", "_place", "_before")
