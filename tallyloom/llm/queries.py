"""The registered queries of the text operators, each a thin call over a whole table, and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, checks, checks_structure, conversations, decontaminate, hard_negatives, html_extract, language, near_dedup, pii, quality_classifier, quality_rules, secrets, substring_dedup, token_counts
from tallyloom.llm.shared import documents, prepare


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(documents(spark, sf_dir))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=4)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(prepare(spark).read.parquet(f"{sf_dir}/pages.parquet"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.remove_repeats(documents(spark, sf_dir), size=13)
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier.classify(docs, labels, ["doc_id"])
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", "predicted")


def encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(documents(spark, sf_dir))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(documents(spark, sf_dir))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_numbers(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_quality_rules": quality,
    "op2_pii_spans": personal_data,
    "op3_token_counts": tokens,
    "op4_near_dedup": near_copies,
    "op5_main_text": page_text,
    "op6_substring_dedup": passages,
    "op7_quality_classifier": classes,
    "op8_bpe_round_trip": encoding,
    "op9_benchmark_leaks": benchmark_leaks,
    "op10_secrets": credentials,
    "op11_language": languages,
    "op12_hard_negatives": negatives,
    "op13_conversations": structure,
}
# The others read trained models, vocabularies or markup; their tests compare them with plain versions.
ORACLE = {
    "op1_quality_rules": checks.QUALITY,
    "op4_near_dedup": checks.NEAR,
    "op6_substring_dedup": checks.PASSAGES,
    "op9_benchmark_leaks": checks.LEAKS,
    "op10_secrets": checks.SECRETS,
    "op11_language": checks_structure.LANGUAGE,
    "op12_hard_negatives": checks_structure.NEGATIVES,
    "op13_conversations": checks_structure.CONVERSATIONS,
}
