"""Shapes of landed payloads, clocks and calendars."""

from datetime import UTC, date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import business_days, local_ending_to_utc
from tidemark.operators import observe
from tidemark.queries import ingestion
from tidemark.plans.pipelines import ingest, read_back
from tidemark.operators.store import Store
from tidemark.sources import landed
from tidemark.streaming.ingest import commit_stream, first_rows, stream_bars


def utc(*a):
    return datetime(*a, tzinfo=UTC)


def times(df):
    return [t.replace(tzinfo=UTC) for (t,) in df.collect()]


def test_hour_endings_across_clock_changes(spark):
    rows = [(date(2026, 6, 1), 60, True), (date(2026, 11, 1), 120, True), (date(2026, 11, 1), 120, False), (date(2026, 11, 1), 180, False), (date(2026, 3, 8), 240, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, day date, m int, dst boolean").orderBy("i")
    got = times(df.select(local_ending_to_utc(F.col("day"), F.col("m"), F.col("dst"), 60, "America/Chicago")))
    assert got == [utc(2026, 6, 1, 6), utc(2026, 11, 1, 7), utc(2026, 11, 1, 8), utc(2026, 11, 1, 9), utc(2026, 3, 8, 9)]


def test_business_days(spark):
    rows = [(date(2024, 1, d), date(2024, 1, d + n)) for d in range(1, 9) for n in range(20)] + [(date(2024, 1, 9), date(2024, 1, 2))]
    got = [r[0] for r in spark.createDataFrame(rows, "a date, b date").select(business_days(F.col("a"), F.col("b"))).collect()]
    assert got == [max(0, int(np.busday_count(a, b))) for a, b in rows]


def json_rows(spark, payloads, schema):
    return spark.createDataFrame(list(enumerate(payloads)), "_order int, t string").select("_order", F.from_json("t", schema).alias("j")).select("_order", "j.*")


def test_weekly_keeps_first_and_hourly_last(spark):
    data = '{"response":{"data":[{"period":"2024-01-05","value":"10"},{"period":"2024-01-05","value":"11"},{"period":"2024-01-12","value":"x"}]}}'
    got = landed.weekly(json_rows(spark, [data], landed.RECORDS), "EIA.NG.STORAGE.LOWER48").collect()
    assert [(r.valid_time, r.value) for r in got] == [(datetime(2024, 1, 5), 10.0)]
    hour = '{"response":{"data":[{"period":"2024-01-05T03","respondent":"ERCO","type":"D","value":"1"},{"period":"2024-01-05T03","respondent":"ERCO","type":"D","value":null}]}}'
    got = landed.hourly_region(json_rows(spark, [hour], landed.RECORDS)).collect()
    assert [(r.instrument_id, r.valid_time, r.value) for r in got] == [("EIA930.D.ERCO", datetime(2024, 1, 5, 3), None)]


def test_reports(spark):
    page = '{"data":[["2026-06-01","1","1","HB_NORTH","20.5","false"],["2026-06-01","1","1","NODE","9","false"],["2026-06-01","1","2","HB_NEW","9","false"]],"fields":[{"name":"deliveryDate"},{"name":"deliveryHour"},{"name":"deliveryInterval"},{"name":"settlementPoint"},{"name":"settlementPointPrice"},{"name":"DSTFlag"}]}'
    raw = json_rows(spark, [page], landed.REPORT)
    got = landed.real_time_prices(raw).collect()
    assert [(r.instrument_id, r.valid_time, r.price) for r in got] == [("ERCOT.SPP.HB_NORTH", datetime(2026, 6, 1, 5, 15), 20.5)]
    assert [r.settlement_point for r in landed.unlisted_points(raw).collect()] == ["HB_NEW"]
    fall = '{"data":[["2026-11-01","02:00","HB_NORTH","20","true"],["2026-11-01","02:00","HB_NORTH","21","false"]],"fields":[{"name":"deliveryDate"},{"name":"hourEnding"},{"name":"settlementPoint"},{"name":"settlementPointPrice"},{"name":"DSTFlag"}]}'
    both = landed.day_ahead_prices(json_rows(spark, [fall], landed.REPORT)).orderBy("valid_time").collect()
    assert [r.price for r in both] == [20.0, 21.0]
    broken = json_rows(spark, ['{"data":[["1"]],"fields":[]}'], landed.REPORT)
    with pytest.raises(Exception, match="report rows without fields"):
        landed.report_rows(broken).collect()


def test_degree_days_and_spot(spark):
    line = "110" + "0" + "25" + "2025" + "".join(f"{v:>7}" for v in ("600.", "-9999.", *["10."] * 10))
    lines = spark.createDataFrame([(line,), ("999" + line[3:],), ("short",)], "value string")
    got = landed.degree_days(lines, "25", "hdd").orderBy("valid_time").collect()
    assert len(got) == 12 and got[0].hdd == 600 and got[1].hdd is None and got[0].instrument_id == "NOAA.HDD.CONUS"
    obs = '{"observations":[{"date":"2024-01-02","value":"."},{"date":"2024-01-03","value":"71.5"}]}'
    assert [r.value for r in landed.spot(json_rows(spark, [obs], landed.OBSERVATIONS), "FRED.WTI.SPOT").collect()] == [71.5]


def test_contract_calendar(spark):
    got = landed.contract_calendar(spark, {"crude": "CL"}, date(2025, 11, 20), 4).orderBy("ContractMonth").collect()
    assert [r.ticker for r in got] == ["CLX25", "CLZ25", "CLF26", "CLG26"]


def test_pipeline_end_to_end(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    data = '{"response":{"data":[%s]}}' % ",".join('{"period":"2024-01-%02d","value":"%d"}' % (d, d) for d in (5, 12, 19))
    raw = json_rows(spark, [data], landed.RECORDS)
    n = ingest(store, "gas_storage", raw, "EIA.NG.STORAGE.LOWER48", as_of=utc(2024, 1, 20), fetched_at=utc(2024, 3, 1), period_end=utc(2024, 1, 20))
    assert [(r.instrument_id, r.n_rows) for r in n.collect()] == [("EIA.NG.STORAGE.LOWER48", 3)]
    assert store.vintages().first().vintage_reconstructed is True
    assert read_back(store, "gas_storage", "fundamentals.eia").count() == 0
    assert observe.catalog(store.vintages()).first().row_count == 3


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(utc(2024, 1, 1, h, m), s, float(h + m)) for s in ("a", "b") for h in range(3) for m in (0, 30)]
    spark.createDataFrame(rows, "ts timestamp, symbol string, value double").write.parquet(src)
    ticks = spark.readStream.schema("ts timestamp, symbol string, value double").parquet(src)
    q = stream_bars(ticks, "1 hour", "0 seconds").writeStream.format("memory").queryName("stream_bars").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.Symbol, r.Datetime.hour): (r.Open, r.High, r.Low, r.Close, r.Volume) for r in spark.table("stream_bars").collect()}
    assert got["a", 1] == (1.0, 31.0, 1.0, 31.0, 2) and len(got) == 6

    store = Store(spark, str(tmp_path / "store"))
    canon = ticks.select(F.concat(F.lit("EIA930.D."), F.upper("symbol")).alias("instrument_id"), F.col("ts").alias("valid_time"), "value", F.lit("2024-01-02").cast("timestamp").alias("fetched_at"))
    for _ in range(2):
        once = first_rows(canon, ["instrument_id", "valid_time"])
        q = commit_stream(once, store, "stream").option("checkpointLocation", str(tmp_path / f"c{_}")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert store.read("power.demand").count() == len(rows)


def test_envelopes_are_bounded(spark, tmp_path):
    rows = spark.range(4500).selectExpr("id event_id", "timestamp'2024-01-05 03:00:00' ts", "'click' event_type", "cast(id as double) value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    size = lambda df, c: df.agg(F.max(F.size(c)), F.sum(F.size(c))).first()
    assert tuple(size(ingestion._spot(spark, str(tmp_path), F.lit("X")), "observations")) == (1000, 4500)
    assert tuple(size(ingestion._payload(spark, str(tmp_path), "yyyy-MM-dd", {"value": F.col("value")}), "response.data")) == (1000, 4500)
    assert [r.value for r in ingestion.a13(spark, str(tmp_path)).collect()] == [1.0]  # event 0 has no number
    assert [r.value for r in ingestion.a02(spark, str(tmp_path)).collect()] == [4499.0]
