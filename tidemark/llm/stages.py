"""Stages of the corpus pipeline: thin adapters of the operators to (spark, docs, sf_dir).

Null and empty texts, repeated rows, ties, empty tables and further columns are handled
as the operators behind them say; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import encode_digests
from tidemark.llm.decontam import without_leaks
from tidemark.llm.jaccard import one_of_each
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.secret_scan import redacted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; calibrated on the labels of those at hand."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8), the one with the least doc_id."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark and n_chars set anew."""
    return redacted(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document kept, with their number and digests."""
    return encode_digests(docs, keep_ids=True)
