"""Corpus pipeline over ``documents``; part of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Each stage works on all that its predecessor kept.
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("redact_secrets", stages.redact),
    ("bpe", stages.tokens),
]

#: SQL can express neither the fingerprints nor the merges; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
