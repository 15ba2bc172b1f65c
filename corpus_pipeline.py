"""A corpus pipeline of five stages over `documents`, each a dealt operator; a stage's output is the next one's input.

Quality rules drop rejected documents, near-dedup keeps one document of each group, secrets are masked in place, the
mix repeats or leaves out documents to meet the source targets, and byte-level BPE encodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakecart.llm import bpe, mixing, near_dups, quality, secrets
from lakecart.llm.store import written

NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.drop_near_duplicates(docs, NEAR_PERCENT)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("secret masking", secret_masking),
    ("source mix", source_mix),
    ("byte-level BPE", byte_bpe),
]

# Set digests, signatures and the tokenizer's merges have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to a work table and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
