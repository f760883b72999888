"""Listings and totals over published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def rows_per_year(df: DataFrame, year_col: str) -> DataFrame:
    """ano, n and total (1 for the row of all years, whose ano is null, else 0)."""
    return df.select(F.col(year_col).alias("ano")).rollup("ano").agg(F.count("*").alias("n"), F.grouping("ano").alias("total"))


def yearly_summary(df: DataFrame, year_col: str, sums: dict[str, str]) -> DataFrame:
    """n and exact sums of a year: sums names the result of each amount column."""
    return df.groupBy(year_col).agg(F.count("*").alias("n"), *(F.sum(F.col(c).cast("decimal(18,2)")).alias(name) for name, c in sums.items()))


def table_stats(tables: dict[str, DataFrame], views: list[str] = ()) -> DataFrame:
    """name, kind, rows and files of tables, and names of views (whose numbers are null), by kind and name."""
    told = [df.agg(F.count("*").alias("rows"), F.count_distinct(F.col("_metadata.file_path")).alias("files")).select(F.lit(n).alias("name"), F.lit("table").alias("kind"), "rows", "files") for n, df in tables.items()]
    none = [told[0].limit(0).sparkSession.range(1).select(F.lit(v).alias("name"), F.lit("view").alias("kind"), F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("files")) for v in views]
    return reduce(DataFrame.unionByName, told + none).orderBy("kind", "name")


def ad_hoc(spark: SparkSession, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Any SQL over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def top_one(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order).limit(1)
