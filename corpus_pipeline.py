"""From raw documents to token ids, stage by stage. Each stage reads what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import bpe, line_quality, mixing, order_minhash, pii
from tarmac.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that are too short, repeat themselves or lose too much."""
    return line_quality.clean(docs, length="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return order_minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs, length="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their targets; a document taken twice is there twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text they came from."""
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), VOCABULARY, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, VOCABULARY, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        "source",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.coalesce("text", F.lit("")).eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL cannot tell near copies by sketch and alignment, learnt contexts or BPE ids; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
