"""The queries op1_ .. op13_ over whole tables, and the SQL that some of them equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_codec,
    hard_negatives,
    html_extract,
    language_id,
    near_dedup,
    packing,
    quality_rules,
    secret_scan,
    spot_signatures,
    substring_dedup,
    token_alignment,
    token_counts,
    toxicity,
)
from ._common import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(table(spark, sf_dir, "documents"), digests=True)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.compare_edited(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), digests=True)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extract,
        op2_packing,
        op3_secret_scan,
        op4_substring_dedup,
        op5_bpe_codec,
        op6_token_counts,
        op7_quality_rules,
        op8_language_id,
        op9_fingerprints,
        op10_near_dedup,
        op11_token_alignment,
        op12_hard_negatives,
        op13_toxicity,
    )
}
ORACLE_SQL = {
    "op4_substring_dedup": substring_dedup.ORACLE_SQL,
    "op10_near_dedup": near_dedup.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
}
