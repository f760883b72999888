"""Registered queries of the corpus operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sql import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), chunks=1_200_000)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import rule_verdicts

    return rule_verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def rule_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cutoffs that small sets of labels allow, at a wide risk: op2's choice held against SQL where it has one."""
    from .common import stored
    from .rules import WIDE_RISK, risk_cutoffs, with_measures

    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "text")
    measured = stored(with_measures(docs).drop("text"), "rule-measures")
    return risk_cutoffs(measured, _table(spark, sf_dir, "labels"), "stratum", risk=WIDE_RISK).where("cutoff is not null")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embeddings import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import encode_pieces

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, tokenizer_file("piece_bpe_32k.model")).select("doc_id", F.size("pieces.ids").cast("long").alias("n_pieces"), "pieces.ids_crc32", "pieces.parity", "pieces.round_trip")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeats_report

    return repeats_report(_table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import Shingles, near_groups

    return near_groups(_table(spark, sf_dir, "documents"), Shingles(4))


def op7_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import find_secrets, train_field

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, train_field(docs))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def spelled(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spelled(base), 256).alias("base_sha256"), spelled("secrets").alias("spans"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import shared_path
    from .warc import manifest_files, read_archives, write_archives

    folder = shared_path(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest_files(spark, folder), folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit_judge, judged

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    judge = fit_judge(docs, _table(spark, sf_dir, "labels"))
    return judged(docs, judge, columns=["doc_id"]).select("doc_id", F.col("_low").alias("p_low"), F.col("_toxic").alias("p_toxic"), F.col("_kept").alias("kept"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngrams import score

    return score(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import counted_words, variant_groups

    return variant_groups(counted_words(_table(spark, sf_dir, "documents")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit_models, languages

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages(docs, fit_models(docs))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_rules": op2_quality_rules,
    "rule_cutoffs": rule_cutoffs,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_minhash": op6_minhash,
    "op7_crf_secrets": op7_crf_secrets,
    "op8_warc": op8_warc,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_phrases": op11_phrases,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language_id": op13_language_id,
}

