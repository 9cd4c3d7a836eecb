"""Datasets that Spark derives from the given tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of each event type."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("Symbol"), F.date_trunc("hour", "ts").alias("Datetime")).agg(
        F.min_by("value", F.struct("ts", "event_id")).alias("Open"), F.max("value").alias("High"), F.min("value").alias("Low"),
        F.max_by("value", F.struct("ts", "event_id")).alias("Close"), F.count("*").alias("Volume"),
    )


BARS = """bars AS (
  SELECT event_type AS "Symbol", date_trunc('hour', ts) AS "Datetime", arg_min(value, ts) AS "Open", max(value) AS "High",
         min(value) AS "Low", arg_max(value, ts) AS "Close", count(*) AS "Volume"
  FROM events GROUP BY 1, 2)"""


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of hours that became known one to five days later, and were revised."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("instrument_id"), F.date_trunc("hour", "ts").alias("valid_time"), F.col("value"), F.col("event_id"),
        (F.date_trunc("day", "ts") + F.make_dt_interval(days=(1 + F.col("event_id") % 5).cast("int"))).alias("as_of"),
    )


VINTAGES = """vintages AS (
  SELECT event_type AS instrument_id, date_trunc('hour', ts) AS valid_time, value, event_id,
         date_trunc('day', ts) + to_days((1 + event_id % 5)::INTEGER) AS as_of
  FROM events)"""


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a scored article."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").alias("Datetime"), F.col("event_type").alias("Symbol"), F.concat(F.lit("headline "), "event_id").alias("news_title"),
        F.concat(F.lit("https://news.example/"), F.col("event_id") % 1000).alias("news_url"),
        ((F.col("event_id") % 21 - 10) / 10.0).alias("sentiment_score"), ((F.col("event_id") % 5) / 4.0).alias("confidence"),
    )


NEWS = """news AS (
  SELECT ts AS "Datetime", event_type AS "Symbol", 'headline ' || event_id AS news_title,
         'https://news.example/' || (event_id % 1000) AS news_url, (event_id % 21 - 10) / 10.0::DOUBLE AS sentiment_score,
         (event_id % 5) / 4.0::DOUBLE AS confidence
  FROM events)"""

#: Headlines that articles take in turn.
HEADLINES = (
    "Crude oil prices surge on production cut", "Natural gas demand weak as glut grows", "Brent steady", "Markets open mixed",
    "LNG shortage lifts gas price, rally expected", "WTI falls, drop in barrel price and decline in demand", "Oversupply fears crash petroleum",
)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an article with one of the headlines."""
    e = table(spark, sf_dir, "events")
    titles = F.array(*map(F.lit, HEADLINES))
    return e.select(
        F.get(titles, (F.col("event_id") % len(HEADLINES)).cast("int")).alias("title"), F.lit(None).cast("string").alias("summary"),
        F.concat(F.lit("https://news.example/"), F.col("event_id") % 500).alias("url"), F.col("ts").alias("published"),
        F.lit(None).cast("timestamp").alias("updated"), F.col("event_type").alias("source"), "event_id",
    )


ARTICLES = """articles AS (
  SELECT (%s)[event_id %% %d + 1] AS title, 'https://news.example/' || (event_id %% 500) AS url, ts AS published_at,
         event_type AS source, event_id
  FROM events)""" % ("[" + ", ".join("'" + h + "'" for h in HEADLINES) + "]", len(HEADLINES))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strip of dated contracts: the mean price of each return flag's lines by date and line number."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    month = F.add_months(F.trunc("o_orderdate", "month"), F.col("l_linenumber"))
    return (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("l_returnflag").alias("Commodity"), F.col("o_orderdate").alias("Datetime"), month.alias("ContractMonth"))
        .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("Close"))
    )


CONTRACTS = """contracts AS (
  SELECT l_returnflag AS "Commodity", o_orderdate AS "Datetime",
         (date_trunc('month', o_orderdate) + to_months(l_linenumber))::DATE AS "ContractMonth", avg(l_extendedprice / l_quantity) AS "Close"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
curves AS (
  SELECT "Commodity", "Datetime"::DATE AS date, "ContractMonth", arg_max("Close", "Datetime") AS price,
         date_diff('day', "Datetime"::DATE, "ContractMonth") AS days_to_maturity
  FROM contracts GROUP BY 1, 2, 3, 5)"""


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison; NaN stays."""
    return df.select(*(F.round(f.name, places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema))
