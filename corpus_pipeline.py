"""Corpus pipeline: quality rules, near-duplicates, benchmark leaks, secrets, token ids.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the
columns of ``documents``, the last one the token ids. Stages decide row by row, whether an id
is missing or repeated or not.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.llm import bpe, leaks, neardup, quality, secret_scan
from postgauge.llm.common import table
from postgauge.session import ensure_checkpoint_dir

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group at similarity 0.8 or more in shingles of five words."""
    return neardup.one_row_per_group(docs, width=5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window of ten words."""
    return leaks.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and whether they decode to its text."""
    return bpe.token_ids(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("without_secrets", without_secrets),
    ("token_ids", token_ids),
]

#: Model scores and token ids have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
