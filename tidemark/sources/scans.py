"""Scans of file drops: declared schemas, drifting columns, keys in file names, sheets, trees and payloads."""

from __future__ import annotations

import csv
import io
import math
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..scratch import stored
from . import commits

#: What is read of a CSV file to find its header, and how many files are looked at at once.
HEADER_BYTES, READERS = 1 << 16, 16

#: Levels of a tree that one pass unnests; documents that one task parses.
LEVELS_AT_ONCE, DOCUMENTS = 4, 20_000


def csv_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files of CSV drops, in order; Spark lists them without opening any."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return [r["path"] for r in spark.read.format("binaryFile").load(paths).select("path").orderBy("path").collect()]


def header_of(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> tuple[str, ...]:
    """The columns that a CSV file's first line names, () for an empty file; reads its first HEADER_BYTES at most.

    A file's mark of its byte order and blanks around names don't count.
    """
    text = commits.read_bytes(spark, path, HEADER_BYTES).decode(encoding, "replace").removeprefix("\ufeff")
    first = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep, quotechar='"', doublequote=True), [])
    return tuple(c.strip() for c in first)


def header_signatures(spark: SparkSession, paths: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """The files of CSV drops by the columns that their headers name, in order; empty files are left out."""
    files = csv_files(spark, paths)
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f, sep, encoding), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for f, h in zip(files, headers, strict=True):
        if h:
            out.setdefault(h, []).append(f)
    return out


def literal_path(path: str) -> str:
    """A path that stands for itself where patterns are understood."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, sep: str = ",", encoding: str = "UTF-8", multi_line: bool = False, unknown: str = "fail", path_col: str | None = None) -> DataFrame:
    """CSV drops under a declared schema, columns taken by the names in each file's header: codes keep their zeros.

    Files may name the columns in any order and case; one that a file lacks is null in its rows. Columns that
    aren't declared fail the read, or with unknown="keep" stay behind the declared ones as text, or with "drop" go; a
    header that names a column twice fails. Files without rows give none. There is one scan for each different header.

    multi_line is for drops whose quoted fields hold line feeds; such files aren't split. Rows that don't fit the
    header fail the job; without multi_line, so does a quoted line feed that leaves a row short. path_col adds the
    path of each row's file.
    """
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    kinds = {f.name.lower(): f for f in declared}
    frames = []
    for header, files in header_signatures(spark, paths, sep, encoding).items():
        names = [c.lower() for c in header]
        odd = [c for c in header if c.lower() not in kinds]
        if len(set(names)) < len(names):
            raise ValueError(f"{files[0]} names a column twice: {', '.join(header)}")
        if odd and unknown == "fail":
            raise ValueError(f"{len(files)} files, {files[0]} for one, have columns that aren't declared: {', '.join(odd)}")
        fields = [T.StructField(c, kinds[c.lower()].dataType if c.lower() in kinds else T.StringType()) for c in header]
        read = spark.read.csv(list(map(literal_path, files)), schema=T.StructType(fields), header=True, sep=sep, encoding=encoding, quote='"', escape='"', multiLine=multi_line, mode="FAILFAST")
        here = {c.lower(): f"`{c}`" for c in header}
        own = [(F.col(here[f.name.lower()]) if f.name.lower() in here else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared]
        rest = [F.col(f"`{c}`") for c in odd] if unknown == "keep" else []
        frames.append(read.select(*own, *rest, *([F.col("_metadata.file_path").alias(path_col)] if path_col else [])))
    if not frames:
        return spark.createDataFrame([], T.StructType([*declared, *([T.StructField(path_col, T.StringType())] if path_col else [])]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def catalog_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A table of the catalog, or some columns of it."""
    return spark.read.table(name).select(*(columns or ["*"]))


def key_predicates(key: str, bounds: list) -> list[str]:
    """Conditions that each row of a table meets exactly one of: no key, below the first bound, between two, from the
    last on."""
    inside = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
    ends = [f"{key} < {bounds[0]}", f"{key} >= {bounds[-1]}"] if bounds else [f"{key} IS NOT NULL"]
    return [f"{key} IS NULL", ends[0], *inside, *ends[1:]]


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, parts: int, **options) -> DataFrame:
    """A database table read by about parts tasks of equal rows, however its whole-number key is spread, and one task for
    rows without a key.

    Bounds are quantiles of the key, told by one pass over that column alone, which the database sends in equal ranges
    of the key. Bounds that fall together are one, so a key that many rows share is one task's. Rows that come
    between the passes are read: the tasks' conditions leave out no key.
    """
    options = {"url": url, "dbtable": table, **options}
    whole = spark.read.format("jdbc").options(**options).load()
    key = next((c for c in whole.columns if c.lower() == key.lower()), key)
    ends = whole.agg(F.min(key), F.max(key)).first()  # the database finds them
    if ends[0] is None:
        bounds = []
    else:
        low, high = int(ends[0]), int(ends[1])
        one = spark.read.format("jdbc").options(**options, partitionColumn=key, lowerBound=low, upperBound=max(high, low + 1), numPartitions=parts).load().select(key)
        told = one.where(F.col(key).isNotNull()).approxQuantile(key, [k / parts for k in range(1, parts)], 0.1 / parts)
        bounds = sorted({math.ceil(x) for x in told})
    properties = {k: str(v) for k, v in options.items() if k not in ("url", "dbtable")}
    quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
    return spark.read.jdbc(url, table, predicates=key_predicates(quoted, bounds), properties=properties)


def csv_to_parquet(spark: SparkSession, source: str | list[str], target: str, schema: T.StructType | str, **options) -> DataFrame:
    """Writes CSV drops as Parquet and reads that."""
    read_csv(spark, source, schema, **options).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order, cast to their types; missing ones are null, others stay behind them."""
    lower = {c.lower(): c for c in df.columns}
    own = [(F.col(lower[f.name.lower()]) if f.name.lower() in lower else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    declared = {f.name.lower() for f in schema}
    return df.select(*own, *(c for c in df.columns if c.lower() not in declared))


def union_by_name(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """Drops whose columns and types drift, as one table: each is cast first, then united by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (conform(f, schema) for f in frames))


def with_file_keys(df: DataFrame, view: str, path: str = "_metadata.file_path", grain_prefix: str = r"drop-(\w+)-") -> DataFrame:
    """granularidade and periodo from paths like .../drop-<grain>-<view>/<view>-<period>.parquet; '' if none."""
    p = F.col(path)
    return df.withColumn("granularidade", F.regexp_extract(p, grain_prefix + view, 1)).withColumn("periodo", F.regexp_extract(p, view + r"-([^/]+)\.parquet", 1))


def with_file_name(df: DataFrame, column: str = "filename") -> DataFrame:
    """The base name of each row's file."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def read_sheet(spark: SparkSession, folder: str, sheet: str, columns: Iterable[str]) -> DataFrame:
    """One sheet of a workbook kept as CSV under sheet=<name>/, all text."""
    return read_csv(spark, f"{folder}/sheet={sheet}", T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def dealt(df: DataFrame, rows_per_task: int = DOCUMENTS) -> DataFrame:
    """df dealt evenly to as many tasks as its rows need, whatever its files' sizes."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task)))


def flatten_tree(df: DataFrame, json_col: str, code: str = "Codigo", description: str = "Descricao", children: str = "NomenclaturaFilha", depth: int | None = None) -> DataFrame:
    """(codigo, descricao) of all nodes of nested JSON arrays, however deep; of one code the last (deepest, then
    furthest) wins. Text that isn't JSON fails the job, and so do children below depth levels, if that is given.

    Documents are parsed once, and LEVELS_AT_ONCE levels unnested in one pass; what lies deeper is written as parsed
    values, and the next pass reads it, dealt evenly, until there is none.
    """
    node = "struct<place:array<int>,codigo:string,descricao:string,below:variant>"
    level = df.select(F.struct(F.array().cast("array<int>").alias("place"), F.lit(None).cast("string").alias("codigo"), F.lit(None).cast("string").alias("descricao"), F.parse_json(json_col).alias("below")).alias("n"))

    def with_children(n: Column) -> Column:
        """The node itself, done with, and its children."""

        def child(x: Column, i: Column) -> Column:
            kids = F.variant_get(x, f"$.{children}", "variant")
            kids = F.when(F.try_variant_get(x, f"$.{children}[0]", "variant").isNotNull(), kids)  # an array that isn't empty
            return F.struct(F.concat(n["place"], F.array(i)).alias("place"), F.variant_get(x, f"$.{code}", "string").alias("codigo"), F.variant_get(x, f"$.{description}", "string").alias("descricao"), kids.alias("below"))

        own = F.struct(n["place"].alias("place"), n["codigo"].alias("codigo"), n["descricao"].alias("descricao"), F.lit(None).cast("variant").alias("below"))
        below = F.transform(F.variant_get(n["below"], "$", "array<variant>"), child)
        return F.concat(F.array(own), F.coalesce(below, F.array().cast(f"array<{node}>")))

    found = []
    while True:
        for _ in range(LEVELS_AT_ONCE):
            level = level.select(F.explode(with_children(F.col("n"))).alias("n"))
        told = stored(level.select("n.*"), f"level-{len(found) * LEVELS_AT_ONCE}")
        deepest, more = told.agg(F.max(F.size("place")), F.count_if(F.col("below").isNotNull())).first()
        if depth is not None and (deepest or 0) > depth:
            raise ValueError(f"tree has more than {depth} levels")
        found.append(told.select("codigo", "descricao", "place").where("codigo is not null"))
        if not more:
            break
        level = dealt(told.where("below is not null")).select(F.struct("place", F.lit(None).cast("string").alias("codigo"), F.lit(None).cast("string").alias("descricao"), "below").alias("n"))
    nodes = reduce(DataFrame.unionByName, found).repartition("codigo")
    return nodes.groupBy("codigo").agg(F.max_by("descricao", F.struct(F.size("place"), F.col("place"))).alias("descricao"))


def explode_payload(df: DataFrame, payload_col: str, item: T.StructType | str, list_field: str | None = None, fetched_at: str | None = None) -> DataFrame:
    """Records of JSON payloads: an array, an object that holds one under list_field, or one object a row."""
    kind = item if isinstance(item, str) else item.simpleString()[7:-1]
    if list_field is None:
        parsed = F.from_json(payload_col, f"array<struct<{kind}>>")
        rows = df.select(F.explode(parsed).alias("r"))
    else:
        rows = df.select(F.explode(F.from_json(payload_col, f"struct<`{list_field}`:array<struct<{kind}>>>")[list_field]).alias("r"))
    out = rows.select("r.*")
    return out if fetched_at is None else out.withColumn("api_consultada_em", F.lit(fetched_at))


def streamed_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any size, read as a stream by the JVM: no more than a buffer of it is held."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def file_metrics(spark: SparkSession, path: str, rows: DataFrame | None = None, whole: int = 1 << 28) -> DataFrame:
    """path, tamanho_bytes and hash_sha256 (SHA-256) of each file; of those that rows was scanned from (files that
    give no row aside, which have 0) num_linhas and num_colunas too.

    Tasks hold files of at most `whole` bytes whole, dealt by their sizes. Larger ones, of which a task could hold no two
    and Spark none over 2 GB, are read as streams, READERS at once, by the driver's JVM.
    """
    files = spark.read.format("binaryFile").load(path)
    told = files.where(F.col("length") <= whole).select("path", F.col("length").alias("tamanho_bytes"), F.sha2("content", 256).alias("hash_sha256"))
    large = files.where(F.col("length") > whole).select("path", "length").collect()
    if large:
        with ThreadPoolExecutor(READERS) as pool:
            hashes = list(pool.map(lambda r: streamed_hash(spark, r["path"]), large))
        told = told.unionByName(spark.createDataFrame([(r["path"], r["length"], h) for r, h in zip(large, hashes, strict=True)], told.schema))
    if rows is None:
        return told
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  both spellings of local files
    scanned = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # told URL-encoded
    counts = rows.groupBy(plain(scanned).alias("_p")).agg(F.count("*").alias("num_linhas"))
    out = told.withColumn("_p", plain(F.col("path"))).join(counts, "_p", "left").drop("_p")
    return out.withColumns({"num_linhas": F.coalesce("num_linhas", F.lit(0).cast("long")), "num_colunas": F.lit(len(rows.columns))})
