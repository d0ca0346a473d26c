"""Queries of this subpackage, with production parameters over whole tables, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainstay.llm import (
    bpe, comparison_sql, html_text, language, line_dedup, mixing, near_dedup, packing, phrases, quality_qda, quality_rules,
    token_counts, topk, whitening,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(_table(spark, folder, "embeddings"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).drop("_row")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, folder, "documents"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(bpe.encode_and_decode(_table(spark, folder, "documents"), WORD_BPE))


def digests(decoded: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, n_tokens, and SHA-256 of the packed ids and of the decoded text."""
    return decoded.select(
        *(keep or ("doc_id",)), (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_digest(_table(spark, folder, "documents"))


def op7_quality_qda(spark: SparkSession, folder: str) -> DataFrame:
    return quality_qda.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.count_tokens(_table(spark, folder, "documents"), WORD_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_vectors(_table(spark, folder, "embeddings"))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), WORD_BPE)


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_top_k, op2_mixing, op3_quality_rules, op4_bpe, op5_html_text, op6_line_dedup, op7_quality_qda, op8_near_dedup,
        op9_language, op10_token_counts, op11_whitening, op12_phrases, op13_packing,
    )
}

SQL: dict[str, str] = comparison_sql.SQL
