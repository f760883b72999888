"""The corpus pipeline: documents in, packed training sequences out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import stored
from tidemark.llm.minhash import Shingles, without_near_copies
from tidemark.llm.packing import pack
from tidemark.llm.quality import fit_judge, judged
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.secrets import redact, train_field
from tidemark.llm.suffixes import without_repeats


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject as low or toxic."""
    judge = fit_judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, judge).where("_kept").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id (five-word shingles, 0.8 or more)."""
    return without_near_copies(docs, Shingles(5))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes or more that a document of a smaller id has; n_chars follows.

    Bytes of a character that was cut apart are dropped.
    """
    out = without_repeats(docs, replace=True)
    n_chars = F.when(F.col("_n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose secrets are masked; n_chars follows."""
    out = redact(docs, train_field(docs))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), chunks=100_000)  # workers go on to other stages and keep these


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", keep_one_of_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: A trained classifier, verified sketches and a tokenizer decide; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
