"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import encode_digests
from tidemark.llm.decontam import leaks
from tidemark.llm.kneser_ney import quality_classifier
from tidemark.llm.licenses import license_scan
from tidemark.llm.manifest_sql import MANIFEST, SPELLING
from tidemark.llm.merkle import tampering_check
from tidemark.llm.mixing import mix_shares
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.quality_sql import SQL as QUALITY_SQL
from tidemark.llm.secret_scan import secret_scan
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.token_counts import token_counts
from tidemark.llm.toxicity import toxicity
from tidemark.llm.url_filter import url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampering_check(table(spark, sf_dir, "documents"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_shares(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_toxicity, op3_decontamination, op4_quality_rules, op5_token_counts,
        op6_secret_scan, op7_url_filter, op8_license_scan, op9_bpe, op10_quality_classifier,
        op11_spelling_variants, op12_merkle_manifest, op13_source_mix,
    )
}

SQL: dict[str, str] = {
    "op4_quality_rules": QUALITY_SQL,
    "op11_spelling_variants": SPELLING,
    "op12_merkle_manifest": MANIFEST,
    "op7_url_filter": r"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?:.*?)://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?:.*?)://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(rule, rhost, rpath, verdict) AS (VALUES
  ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'),
  ('net/de/', 'net', '/de/', 'allow'), ('example.net/de/8', 'example.net', '/de/8', 'block'),
  ('org/es/', 'org', '/es/', 'block')),
best AS (
  SELECT page_id, host, path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
""",
}
