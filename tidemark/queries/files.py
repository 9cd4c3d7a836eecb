"""Queries of the data sources of landed files: payloads derived from the tables are written as files, and read as batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.queries.derived import rounded
from tidemark.queries.holdings import scratch_store
from tidemark.queries.ingestion import _LINES, _ORDERS, _PRICES, _lines, _real_time
from tidemark.queries.streams import _to_end
from tidemark.sources import files, landed


def _pages(s: SparkSession, d: str) -> str:
    """A folder of report files, an envelope a line, files and lines in order of arrival."""
    files.register(s)
    folder = f"{scratch_store(s).root}/reports"
    pages = _real_time(s, d).repartitionByRange(4, "_order").sortWithinPartitions("_order")
    pages.select(F.to_json(F.struct("data", "fields")).alias("value")).write.text(folder)
    return folder


def _counts(rows: DataFrame) -> DataFrame:
    m = F.col("m")
    return rows.select(m["settlementPoint"].alias("settlement_point"), m["deliveryHour"].cast("int").alias("hour")).groupBy("settlement_point", "hour").agg(F.count("*").alias("n"))


def a26(s, d):
    return rounded(landed.real_time_prices(s.read.format("landed_reports").load(_pages(s, d))), 2)


def a27(s, d):
    rows = s.readStream.format("landed_reports").option("columns", "settlementPoint,deliveryHour").load(_pages(s, d))
    return _counts(_to_end(s, rows))


def _editions(s: SparkSession, d: str) -> str:
    """A folder of two editions; January of the older one is wrong throughout."""
    files.register(s)
    folder = f"{scratch_store(s).root}/editions"
    lines = _lines(s, d, "25")
    for day, value in (("20240105", F.concat(F.substring("value", 1, 10), F.lit("   777."), F.substring("value", 18, 77))), ("20240205", F.col("value"))):
        lines.select(value.alias("value")).write.text(f"{folder}/climdiv-hddcst-v1.0.0-{day}")
    return folder


def _degree_days(reader, folder: str) -> DataFrame:
    return reader.format("degree_day_files").option("kind", "hddcst").option("element", "25").load(folder).withColumnRenamed("value", "hdd")


def a28(s, d):
    return _degree_days(s.read, _editions(s, d))


def a29(s, d):
    return _to_end(s, _degree_days(s.readStream, _editions(s, d)))


ENTRIES = {
    "A26_report_source": (a26, f"WITH {_PRICES} SELECT 'ERCOT.SPP.' || point AS instrument_id, valid_time, point AS settlement_point, price FROM rt"),
    "A27_report_stream": (a27, f"WITH {_ORDERS} SELECT point AS settlement_point, hour::INTEGER AS hour, count(*) AS n FROM o GROUP BY 1, 2"),
    "A28_degree_day_source": (a28, f"WITH {_LINES} SELECT instrument_id, valid_time, v AS hdd FROM cells"),
    "A29_degree_day_stream": (a29, f"WITH {_LINES} SELECT instrument_id, valid_time, v AS hdd FROM cells"),
}
