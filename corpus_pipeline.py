"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame, which run() writes as Parquet to the shared folder
and reads again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import language_id, near_dedup, packing, secret_scan, substring_dedup
from tidepool.llm._common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of doubtful language go."""
    return language_id.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 35 words that occur elsewhere too go; documents that lose every word go."""
    return substring_dedup.remove_repeats(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets of any layer become a mark."""
    return secret_scan.redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Language identification and packing can't be said in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
