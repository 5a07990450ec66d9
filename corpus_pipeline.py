"""A training corpus in five stages: quality, near duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a frame; the frame is written as Parquet in the shared
folder and read again as the docs of the next stage. All but the last return the columns of documents.

Null or empty texts are scored like any text by the first stage; what is kept of them passes the others unchanged. Repeated rows are kept or dropped together. Empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, decontaminate, near_dedup, pii, quality_classifier
from tallyloom.llm.queries import tokenizer
from tallyloom.llm.shared import prepare, stash


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.accepted(docs, labels)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    prepare(spark)
    return near_dedup.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    prepare(spark)
    return pii.redact(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids): what a training run reads. Decoding the ids gives the text back."""
    prepare(spark)
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer("byte_bpe_50k.json")).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_copy),
    ("benchmark", drop_benchmark),
    ("personal_data", hide_personal_data),
    ("token_ids", to_token_ids),
]

# The first stage is a trained model, which SQL cannot express; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir))
    return docs
