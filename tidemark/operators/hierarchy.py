"""A code tree as flat tables: prefixes stand for ancestors."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.columns import LEVELS, digits_only, level_name
from ..scratch import stored

#: Names of the levels' columns, by digits (fixed values).
LEVEL_COLUMNS = {2: "capitulo", 4: "posicao", 5: "subposicao_1", 6: "subposicao_2", 7: "item", 8: "subitem"}


def prefix_lookup(nodes: DataFrame, lengths: tuple[int, ...] = (2, 4, 5, 6, 7, 8), leaf: int = 8) -> DataFrame:
    """Each leaf under each of its prefixes that is a node: prefixo, codigo (the leaf), descricao, nivel,
    capitulo_codigo, capitulo_descricao of the node, caminho of the leaf. Nodes are written once; then one
    explode and one join."""
    base = stored(nodes, "tree").withColumn("prefixo", digits_only(F.col("codigo")))
    leaves = base.where(F.length("prefixo") == leaf).select(F.col("prefixo").alias("codigo_8"), F.col("caminho").alias("caminho_8"))
    cut = leaves.select("*", F.explode(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.left("codigo_8", n))).alias("prefixo"))
    kept = base.where(F.length("prefixo").isin(*lengths)).select("prefixo", "descricao", "nivel", "capitulo_codigo", "capitulo_descricao")
    return cut.join(kept, "prefixo").select("prefixo", F.col("codigo_8").alias("codigo"), "descricao", "nivel", "capitulo_codigo", "capitulo_descricao", F.col("caminho_8").alias("caminho"))


WALK = "code string, digits string, part int, place long, twin int, twins int, deep int, parent string, shared int, under long, kids long"


def _walk(batches: Iterator[pa.RecordBatch], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One range of nodes in preorder (code, digits, part): what a walk with a stack of open nodes tells of each.

    place within the range; of spellings of the same digits (twins) which one; depth, parent, nodes under and children,
    as far as the range goes; shared: how many first digits the node and all before it share with the range's first,
    which tells what of earlier ranges it lies under.
    """
    done: list[tuple] = []
    stack: list[tuple[str, list[str], list[int], int, int]] = []  # digits, codes, [first place, under, kids], depth, shared
    first, last, shared, place, part = None, None, 0, 0, 0

    def close() -> None:
        digits, codes, (at, under, kids), deep, own = stack.pop()
        parent = stack[-1][1][0] if stack else None
        done.extend((c, digits, part, at + i, i, len(codes), deep, parent, own, under, kids) for i, c in enumerate(codes))
        if stack:
            above = stack[-1][2]
            above[1] += under + len(codes)
            above[2] += len(codes)

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    for batch in batches:
        for code, digits, part in zip(*(batch.column(c).to_pylist() for c in ("code", "digits", "part")), strict=True):
            if (digits, code) == last:
                continue
            last = (digits, code)
            if first is None:
                first = digits
                shared = len(digits)
            shared = min(shared, len(os.path.commonprefix([first, digits])))
            if stack and stack[-1][0] == digits:
                stack[-1][1].append(code)
            else:
                while stack and (not stack[-1][0] or not digits.startswith(stack[-1][0])):
                    close()
                stack.append((digits, [code], [place, 0, 0], len(stack), shared))
            place += 1
        if len(done) > 10_000:
            yield out()
    while stack:
        close()
    if done:
        yield out()


def intervals(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """code, ordem (number in preorder, from 1), fim (number of the last node under it, else of its own digits),
    profundidade (how many nodes it lies under, those of the same digits counted once), pai (the closest of them),
    n_filhos and n_descendentes (0 for none) of each distinct node.

    A node lies under those whose digits begin its own; what lies under it has the numbers behind it up to fim, so
    ancestors contain and descendants are a difference. Of spellings of the same digits the first is the parent.

    One sort into ranges numbers all nodes, and a walk over each range finds what lies under what. What reaches over
    ranges is told by the ranges' first nodes alone, whose beginnings are looked up in the table. No code's beginnings
    are joined and no group is gathered: a node that a third of all lie under is counted once a range.
    """
    spark = nodes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = stored(nodes.select(F.col(code).alias("code"), digits_only(F.col(code)).alias("digits")).where("code is not null"), "codes")
    ranged = plain.repartitionByRange(n, "digits").sortWithinPartitions("digits", "code").select("code", "digits", F.spark_partition_id().alias("part"))
    arrow = to_arrow_schema(T.StructType.fromDDL(WALK))
    told = stored(ranged.mapInArrow(lambda batches: _walk(batches, arrow), WALK), "walk")
    parts = told.groupBy("part").agg(F.count("*").alias("n"), F.min("digits").alias("first")).orderBy("part").collect()  # a row a range
    before, at = [], 0
    for r in parts:
        before.append((r["part"], at))
        at += r["n"]
    begin = spark.createDataFrame([(r["part"], r["first"][:k]) for r in parts for k in range(1, len(r["first"]))], "part int, digits string")
    met = told.where("twin = 0").select("digits", "code").join(F.broadcast(begin), "digits").collect()  # ranges times depth at most
    open_ = spark.createDataFrame([(r["part"], r["digits"], len(r["digits"]), r["code"]) for r in met], "part int, digits string, len int, code string")
    over_ranges: dict[int, list] = {r["part"]: [] for r in parts}
    for r in sorted(met, key=lambda r: len(r["digits"])):
        over_ranges[r["part"]].append((len(r["digits"]), r["code"]))
    offsets = spark.createDataFrame([(p, at, over_ranges[p]) for p, at in before], "part int, _before long, _above array<struct<len:int,code:string>>")
    over = F.coalesce(F.filter("_above", lambda x: x["len"] <= F.least(F.col("shared"), F.length("digits") - 1)), F.array().cast("array<struct<len:int,code:string>>"))
    roots = told.where("parent is null and twin = 0").groupBy("part", "shared", F.length("digits").alias("_len")).agg(F.sum("twins").alias("_kids"), F.sum(F.col("under") + F.col("twins")).alias("_under"))
    met = roots.join(F.broadcast(open_), "part").where(F.col("len") <= F.least(F.col("shared"), F.col("_len") - 1))
    closest = F.max("len").over(Window.partitionBy("part", "shared", "_len"))
    more = met.withColumn("_closest", closest).groupBy("digits").agg(F.sum("_under").alias("_more"), F.sum(F.when(F.col("len") == F.col("_closest"), F.col("_kids")).otherwise(0)).alias("_more_kids"))
    j = told.join(F.broadcast(offsets), "part").join(F.broadcast(more), "digits", "left").withColumn("_over", over)
    number = F.col("place") + F.col("_before") + 1
    under = F.col("under") + F.coalesce("_more", F.lit(0))
    kids = F.when(F.col("twin") == 0, F.col("kids") + F.coalesce("_more_kids", F.lit(0))).otherwise(0)
    parent = F.coalesce("parent", F.try_element_at("_over", F.lit(-1))["code"])
    return j.select(F.col("code").alias(code), number.alias("ordem"), (number - F.col("twin") + F.col("twins") - 1 + under).alias("fim"), (F.col("deep") + F.size("_over")).cast("long").alias("profundidade"), parent.alias("pai"), kids.cast("long").alias("n_filhos"), under.cast("long").alias("n_descendentes"))


def parents(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """code and pai: the longest proper prefix that is a node, null if there is none."""
    return intervals(nodes, code).select(code, "pai")


def enrich(nodes: DataFrame, root: str = "Nomenclatura Comum do Mercosul") -> DataFrame:
    """codigo, descricao, nivel, caminho and code and description of the ancestor (or self) at each level.

    Nodes at no known level drop out, those whose chapter isn't a node, and those below a node of an unknown level
    (of three digits or more). Nodes are written once; then one explode of each code's prefixes, one join with the
    nodes and one aggregation, which tells both the ancestors and what drops out. caminho joins the descriptions
    from the root down with ' > '.
    """
    base = stored(nodes.select("codigo", "descricao", digits_only(F.col("codigo")).alias("_c")), "tree")
    known = base.where(F.length("_c").isin(*LEVELS))
    asked = known.select("codigo", "descricao", F.explode(F.transform(F.sequence(F.lit(2), F.length("_c")), lambda n: F.left("_c", n))).alias("_p"), "_c")
    told = asked.join(base.select(F.col("_c").alias("_p"), F.col("codigo").alias("_code"), F.col("descricao").alias("_text")), "_p")
    at = {n: F.length("_p") == n for n in LEVELS}
    cols = [F.max(F.when(at[n], F.col(v))).alias(f"{LEVEL_COLUMNS[n]}_{k}") for n in LEVELS for k, v in (("codigo", "_code"), ("descricao", "_text"))]
    odd = F.count_if(~F.length("_p").isin(*LEVELS)).alias("_odd")
    out = told.groupBy("codigo", "descricao").agg(*cols, odd).where("_odd = 0 and capitulo_codigo is not null").drop("_odd")
    path = F.concat_ws(" > ", F.lit(root), *(F.col(f"{c}_descricao") for c in LEVEL_COLUMNS.values()))
    names = [c for c in out.columns if c not in ("codigo", "descricao")]
    return out.select("codigo", "descricao", level_name(F.col("codigo")).alias("nivel"), *names).withColumn("caminho", path)


def depth(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """code and profundidade: how many of its proper prefixes are nodes."""
    return intervals(nodes, code).select(code, "profundidade")


def child_count(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """code and n_filhos of nodes that have children."""
    return intervals(nodes, code).where("n_filhos > 0").select(code, "n_filhos")


def descendant_count(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """code and n_descendentes (itself aside) of nodes that have any."""
    return intervals(nodes, code).where("n_descendentes > 0").select(code, "n_descendentes")


def prune(nodes: DataFrame, most: int, code: str = "codigo") -> DataFrame:
    """Nodes of at most this depth."""
    return nodes.join(depth(nodes, code).where(F.col("profundidade") <= most), code, "left_semi")


def search(nodes: DataFrame, text: str, column: str = "descricao") -> DataFrame:
    """Nodes whose description holds the text, in either case."""
    return nodes.where(F.contains(F.lower(F.col(column)), F.lower(F.lit(text))))


def select_code(nodes: DataFrame, value: str, code: str = "codigo") -> DataFrame:
    return nodes.where(F.col(code) == value)


def preorder(nodes: DataFrame, code: str = "codigo") -> DataFrame:
    """Nodes from each parent to its children: the order of the dotless codes."""
    return nodes.orderBy(digits_only(F.col(code)))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()
