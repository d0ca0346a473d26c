"""The corpus pipeline: quality, line dedup, near-duplicates, mixing, BPE, over the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mainstay.llm import bpe, line_dedup, mixing, near_dedup, quality_qda
from mainstay.llm.registry import WORD_BPE, digests
from mainstay.scratch import written

# No source is read more than so often, and each at least once, so mixing repeats documents but drops none.
MAX_REPEATS = 2.0

# The mixing and the near-duplicate stages rest on hashes and models that DuckDB's SQL doesn't have.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of documents still there."""
    return quality_qda.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in one of a smaller number; n_chars follows the text."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest number, of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of the sources has them."""
    mixture = mixing.mix(docs, target_entropy=None, max_repeats=MAX_REPEATS, whole=True)
    return mixing.apply_mix(docs, mixture)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, token_ids (packed 32-bit) and the digests of ids and of the decoded text."""
    return digests(bpe.encode_and_decode(docs, WORD_BPE, keep=("doc_id", "source")), "doc_id", "source", "token_ids")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("mixing", mixed),
    ("BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
