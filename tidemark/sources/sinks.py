"""Sinks: append of changed keys, snapshots that switch at once, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..operators import changes
from ..operators.history import as_of
from ..scratch import small, stored
from . import commits

#: Change lists up to this many keys are broadcast.
CHANGES = 200_000

#: Grams that a name is sought by one of, and hashes of such grams that a join broadcasts at most.
OFFERED, GRAMS = 2, 2_000_000
#: The partition column of tables laid out by bucket of their key.
BUCKET = "_bucket"
#: Columns of checked snapshots: the rules that a row breaks, and whether it breaks none.
BROKEN, KEPT = "_broken", "_kept"
#: The partition column of histories laid out by end, and what open versions have there: later than any month.
END, OPEN = "_end", "open"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at path, in whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def changed_rows(source: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are in the change list."""
    return source.join(small(listed.select(*keys).distinct(), CHANGES), keys, "left_semi")


def append_once(rows: DataFrame, target: str, run: str) -> commits.State:
    """Appends rows as a numbered commit unless the run has made one: readers of commits.committed() see whole runs,
    once each, whatever was tried and failed. Of two writers at once, the second fails."""
    spark = rows.sparkSession
    now = commits.state(spark, target)
    if run in now.runs:
        return now
    folder = commits.new_folder("append")
    rows.write.parquet(f"{target}/{folder}")
    return commits.commit(spark, target, now, run, [*now.folders, folder])


def incremental_append(source: DataFrame, listed: DataFrame, keys: list[str], target: str, run: str | None = None) -> DataFrame:
    """The first run writes all rows; later ones append those of changed keys. Returns the table.

    A run tried again under its name, after a crash or though it had succeeded, counts once; see append_once(). Without
    a name each call is a run.
    """
    spark = source.sparkSession
    rows = changed_rows(source, listed, keys) if commits.state(spark, target).number else source
    return commits.committed(spark, target, source.schema, append_once(rows, target, run or uuid.uuid4().hex))


def export_table(df: DataFrame, path: str) -> DataFrame:
    """A table or view as Parquet files."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_delta(delta: DataFrame, base: str, load_ts: str) -> str:
    """A delta under its own load time."""
    path = f"{base}/load_ts={load_ts}"
    delta.write.mode("errorifexists").parquet(path)
    return path


def replace_snapshot(df: DataFrame, base: str, version: str, keys: list[str] | None = None, buckets: int = 64) -> str:
    """A new snapshot beside the old ones, then a numbered commit that names it: readers never see half of one, and the
    last commit counts, however versions are spelt. A version committed before stays as it was.

    With keys, rows lie by bucket of their key beside digests of the buckets, for changes_since().
    """
    spark, now = df.sparkSession, commits.state(df.sparkSession, base)
    if version in now.runs:
        return f"{base}/{now.info['versions'][version]}"
    folder = commits.new_folder("snapshot")
    info = {"versions": {**now.info.get("versions", {}), version: folder}}
    if keys:
        laid = df.withColumn(BUCKET, key_bucket(df, keys, buckets))
        laid.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{base}/{folder}")
        written = spark.read.schema(laid.schema).parquet(f"{base}/{folder}")
        info |= {"keys": keys, "buckets": buckets, "digests": bucket_digests(written)}
    else:
        df.write.parquet(f"{base}/{folder}")
    commits.commit(spark, base, now, version, [folder], info)
    return f"{base}/{folder}"


def current_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    """The snapshot that was committed last, None if there is none."""
    now = commits.state(spark, base)
    return spark.read.parquet(f"{base}/{now.folders[0]}").drop(BUCKET) if now.number else None


def key_bucket(df: DataFrame, keys: list[str], buckets: int) -> Column:
    """The bucket of a row's key; nulls count, wherever they stand."""
    return F.pmod(changes.row_print(df.select(*keys).schema), F.lit(buckets)).cast("int")


def bucket_digests(rows: DataFrame) -> dict[str, list]:
    """Rows and order-independent hashes of each bucket that has rows: one aggregation, a row a bucket."""
    schema = T.StructType([f for f in rows.schema if f.name != BUCKET])
    told = rows.groupBy(BUCKET).agg(*changes.prints(schema))
    return {str(r[0]): [int(r[1]), str(r[2]), int(r[3])] for r in told.collect()}


def changes_since(df: DataFrame, base: str, keys: list[str]) -> DataFrame:
    """Rows of df whose key is new since the last snapshot of base or whose content differs; all, without a snapshot.

    Digests of df's buckets are held against those stored with the snapshot, which was laid out by the same keys;
    only buckets that differ are read, of the snapshot by partition and of df by a filter, and compared field by field.
    """
    spark, now = df.sparkSession, commits.state(df.sparkSession, base)
    if not now.number:
        return df
    if now.info.get("keys") != keys or "digests" not in now.info:
        raise ValueError(f"the snapshot of {base} has no digests by {keys}")
    laid = df.withColumn(BUCKET, key_bucket(df, keys, now.info["buckets"]))
    before = spark.read.schema(laid.schema).parquet(f"{base}/{now.folders[0]}")
    mine, theirs = bucket_digests(laid), now.info["digests"]
    differ = [int(b) for b in mine if mine[b] != theirs.get(b)]
    return changes.snapshot_diff(laid.where(F.col(BUCKET).isin(differ)).drop(BUCKET), before.where(F.col(BUCKET).isin(differ)).drop(BUCKET), keys)


def save_manifest(df: DataFrame, keys: list[str], base: str, version: str) -> str:
    """A manifest in the order of its keys as a new version; the pointer to it, written last, commits a run.

    Until then readers see the manifest before, so df may be made from it, and a crash loses nothing.
    """
    return replace_snapshot(df.orderBy(*keys), base, version)


def refresh_table(df: DataFrame, table: str) -> DataFrame:
    """A full refresh of a table of the catalog."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.read.table(table)


def publish_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """A view of the catalog under a query over its tables, replaced if it is there."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.read.table(view)


def grams_of(text: Column, size: Column) -> Column:
    """The distinct substrings of a length, none of a shorter text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, size)))


def offered_grams(names: DataFrame, name: str, gram: int = 8) -> DataFrame:
    """_name, the length _k of its grams, and as hashes the OFFERED of its grams that the fewest names have.

    Both sides are shuffled: Spark takes a name's grams for as large as the name, and would broadcast those of 100,000 names.
    """
    told = names.select(F.col(name).alias("_name")).where("_name <> ''").distinct().withColumn("_k", F.least(F.length("_name"), F.lit(gram)))
    told = told.select("_name", "_k", F.explode(F.transform(grams_of(F.col("_name"), F.col("_k")), lambda g: F.xxhash64(g))).alias("_gram"))
    common = told.groupBy("_gram").agg(F.count("*").alias("_names"))
    best = F.row_number().over(Window.partitionBy("_name").orderBy("_names", F.xxhash64("_gram"), "_gram"))
    return told.join(common.hint("merge"), "_gram").withColumn("_rank", best).where(F.col("_rank") <= OFFERED).select("_name", "_k", "_gram")


def contained_names(rows: DataFrame, row: str, column: str, names: DataFrame, name: str, gram: int = 8) -> DataFrame:
    """Pairs of row and _name that may match, as the row's text has the name's rarest gram: what must be looked at.

    A name offers the OFFERED of its grams that the fewest names have (gram long, or as long as a shorter name), so
    names that begin alike are sought by what tells them apart. Texts give their grams of these lengths, of which only
    offered ones are kept and counted, as hashes. A name with an offered gram that no text has is in none; the others
    are sought by the offered gram that the fewest texts have.
    """
    told = stored(offered_grams(names, name, gram), "names")
    lengths = [r[0] for r in told.select("_k").distinct().collect()]  # gram numbers at most
    text = F.coalesce(F.col(column), F.lit(""))
    cut = rows.select(row, text.alias("_t"), F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("_k")).where(F.length("_t") >= F.col("_k"))
    cut = cut.select(row, "_t", "_k", F.explode(F.sequence(F.lit(1), F.length("_t") - F.col("_k") + 1)).alias("_at"))
    parts = cut.select(row, F.xxhash64(F.substring("_t", F.col("_at"), F.col("_k"))).alias("_gram"))  # a gram comes again where a text repeats it
    parts = stored(parts.join(small(told.select("_gram").distinct(), GRAMS), "_gram", "left_semi"), "grams")
    counts = parts.groupBy("_gram").agg(F.count("*").alias("_texts"))
    anchors = told.join(counts, "_gram", "left").groupBy("_name").agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_rarest"))
    anchors = anchors.where("_rarest.n > 0").select("_name", F.col("_rarest.gram").alias("_gram"))
    return parts.join(small(anchors, CHANGES), "_gram").select(row, "_name").distinct()


def containing_rows(source: DataFrame, column: str, names: DataFrame, name: str, gram: int = 8) -> DataFrame:
    """Rows whose text in column contains one of the names (blank and null ones aside).

    No pair of row and name is tried blindly: see contained_names(). Names of at most gram characters need no look.
    """
    rows = stored(source.withColumn("_row", F.monotonically_increasing_id()), "rows")
    pairs = contained_names(rows, "_row", column, names, name, gram)
    hits = pairs.join(rows.select("_row", F.col(column).alias("_text")), "_row").where(F.contains("_text", "_name")).select("_row").distinct()
    return rows.join(hits, "_row", "left_semi").drop("_row")


class QualityFailed(RuntimeError):
    """More rows break a rule than it allows, or a total is off; nothing was published. metrics: what was counted."""

    def __init__(self, message: str, metrics: dict):
        super().__init__(message)
        self.metrics = metrics


def checked_snapshot(df: DataFrame, base: str, version: str, rules: dict[str, Column], most: dict[str, int] | None = None, totals: dict[str, tuple[str, object]] | None = None) -> dict:
    """Publishes the rows that keep all rules as a snapshot, and those that break some beside it; returns the counts.

    rules: a condition a row must meet, null being a break, by name; most: how many may break each (any number, if a
    rule isn't named). totals: by name a column whose sum over all rows must be as given. The same job that writes
    counts and adds up, so df is read once; if a check fails what it wrote is never committed and readers keep what
    was there. quarantined() reads the rows that broke rules, with the names of these.
    """
    spark, now = df.sparkSession, commits.state(df.sparkSession, base)
    if version in now.runs:
        return now.info["metrics"]
    seen, folder = Observation(), commits.new_folder("checked")
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items())))
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.array_contains(BROKEN, n)).alias(f"broken_{n}") for n in rules)]
    sums = [F.sum(c).cast("string").alias(f"sum_{n}") for n, (c, _) in (totals or {}).items()]
    told = df.withColumn(BROKEN, broken).observe(seen, *counts, *sums)
    told.withColumn(KEPT, F.size(BROKEN) == 0).write.partitionBy(KEPT).parquet(f"{base}/{folder}")
    metrics = dict(seen.get)
    off = [f"{n}: {metrics[f'broken_{n}']} rows break it, {m} may" for n, m in (most or {}).items() if metrics[f"broken_{n}"] > m]
    off += [f"{n}: {metrics[f'sum_{n}']}, not {want}" for n, (_, want) in (totals or {}).items() if str(want) != str(metrics[f"sum_{n}"])]
    if off:
        raise QualityFailed(f"version {version} of {base} isn't published: " + "; ".join(off), metrics)
    schema = told.schema.jsonValue()
    commits.commit(spark, base, now, version, [folder], {"metrics": metrics, "schema": schema})
    return metrics


def checked(spark: SparkSession, base: str, kept: bool = True) -> DataFrame:
    """The rows of the checked snapshot that was committed last: those that keep all rules, or those that don't."""
    now = commits.state(spark, base)
    schema = T.StructType.fromJson(now.info["schema"]).add(KEPT, T.BooleanType())
    rows = spark.read.schema(schema).parquet(f"{base}/{now.folders[0]}").where(F.col(KEPT) == kept).drop(KEPT)
    return rows.drop(BROKEN) if kept else rows


def quarantined(spark: SparkSession, base: str) -> DataFrame:
    """The rows of the last checked snapshot that broke rules, with their names in `_broken`."""
    return checked(spark, base, kept=False)


def history_by_end(history: DataFrame, base: str, version: str) -> str:
    """A history as a snapshot laid out by the month its versions end in, open ones apart, for history_on()."""
    now = commits.state(history.sparkSession, base)
    if version in now.runs:
        return f"{base}/{now.folders[0]}"
    folder = commits.new_folder("history")
    end = F.when(F.col("is_current"), OPEN).otherwise(F.date_format("valido_ate", "yyyy-MM"))
    history.withColumn(END, end).hint("rebalance", END).write.partitionBy(END).parquet(f"{base}/{folder}")
    commits.commit(history.sparkSession, base, now, version, [folder], {"schema": history.schema.jsonValue()})
    return f"{base}/{folder}"


def history_on(spark: SparkSession, base: str, day: str) -> DataFrame:
    """Versions that held on a day, as as_of() tells; months that ended before it aren't read."""
    now = commits.state(spark, base)
    schema = T.StructType.fromJson(now.info["schema"]).add(END, T.StringType())
    rows = spark.read.schema(schema).parquet(f"{base}/{now.folders[0]}")
    return as_of(rows.where(F.col(END) >= day[:7]), day).drop(END)


def expired_loads(spark: SparkSession, base: str, now: str, days: int) -> DataFrame:
    """load_ts of the load partitions (load_ts=…) of base that are older than so many days before now."""
    loads = spark.read.parquet(base).select(F.col("load_ts").cast("string").alias("load_ts")).distinct()
    return loads.where(F.col("load_ts").cast("timestamp_ntz") < F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAY"))


def drop_expired_loads(spark: SparkSession, base: str, now: str, days: int, dry_run: bool = True) -> list[str]:
    """Retention: the load partitions that go, and unless it is a dry run, gone."""
    gone = sorted(r["load_ts"] for r in expired_loads(spark, base, now, days).collect())  # a row a load
    for load in [] if dry_run else gone:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/load_ts={load}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return gone
