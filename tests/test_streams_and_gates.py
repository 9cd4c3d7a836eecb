"""As-of join of streams, gates that watch a write, order of landed files, mergeable quantiles."""

import json
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import charts, gate
from tidemark.operators.store import Store
from tidemark.plans.pipelines import ingest
from tidemark.sources import landed
from tidemark.streaming.asof import as_of_stream

T0 = datetime(2024, 1, 1)
BARS, SCORES = "Symbol string, Datetime timestamp, Close double", "Symbol string, window_end timestamp, sentiment_score double, confidence double, news_count long"


def test_as_of_join_of_streams(spark, tmp_path):
    """Scores that come after their bars, bars without any, symbols that fall silent."""
    hour = lambda h: T0 + timedelta(hours=h)
    bars = [[("A", hour(h), float(h)) for h in (1, 2, 3)] + [("B", hour(1), 1.0)], [("A", hour(h), float(h)) for h in (4, 30)], [("A", hour(h), float(h)) for h in (31, 90)]]
    scores = [[("A", hour(3), 0.3, 1.0, 3)], [("A", hour(2), 0.2, 1.0, 2), ("A", hour(29), 0.9, 1.0, 9)], [("C", hour(5), 0.5, 1.0, 5), ("A", hour(1), 0.7, 1.0, 7)]]
    for name, files, schema in (("b", bars, BARS), ("s", scores, SCORES)):
        for rows in files:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    left, right = (spark.readStream.schema(x).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{n}") for n, x in (("b", BARS), ("s", SCORES)))
    out = as_of_stream(left, right, late="24 hours")
    q = out.writeStream.format("parquet").option("path", f"{tmp_path}/o").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.Symbol, r.Close): (r.sentiment_score, r.news_count) for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/o").collect()}
    # the score of hour 1 comes with the batch that gives out its bar; the bar of hour 90 waits
    assert got == {("A", 1.0): (0.7, 7), ("A", 2.0): (0.2, 2), ("A", 3.0): (0.3, 3), ("A", 4.0): (0.3, 3), ("A", 30.0): (0.9, 9), ("A", 31.0): (0.9, 9), ("B", 1.0): (0.0, 0)}


@pytest.mark.parametrize("name", ["ERCOT_SPP", "POWER_GEN_BY_FUEL", "OHLCV", "FRED_SPOT"])
def test_a_watched_write_finds_what_a_scan_finds(spark, tmp_path, name):
    g, rng = gate.GATES[name], random.Random(name)
    now = datetime(2024, 1, 20, tzinfo=UTC)

    def value(f):
        if f.name == "valid_time":
            return str(T0 + timedelta(days=rng.randrange(18)))
        return rng.choice(["1.5", "-5", "1e9", "NaN", "n/a", None, "HB_NORTH"])

    for k, n in enumerate((40, 1)):
        rows = [tuple(value(f) for f in g.all_fields) for _ in range(n)]
        df = spark.createDataFrame(rows, ", ".join(f"{f.name} string" for f in g.all_fields)).drop(*(["instrument_id"] if k else []))
        checked, found = gate.watched(df, g)
        checked.write.parquet(f"{tmp_path}/{k}")
        written = spark.read.schema(checked.schema).parquet(f"{tmp_path}/{k}")
        mine = {(f["check"], f["column"], f["n_failed"]) for f in found(now) + gate.repeated_keys(written, g)}
        assert mine == {tuple(r) for r in gate.failures(df, g, now).collect()} and mine


def test_a_refused_batch_leaves_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    data = {"response": {"data": [{"period": "2024-01-05", "value": "-4"}, {"period": "2024-01-12", "value": "7"}]}}
    raw = spark.createDataFrame([(json.dumps(data),)], "j string").select(F.from_json("j", landed.RECORDS).alias("j")).select("j.*")
    at = datetime(2024, 1, 13, tzinfo=UTC)
    with pytest.raises(gate.QualityGateError, match=r"band\(value\): 1 \(-4.0\)"):
        ingest(store, "gas_storage", raw, "EIA.NG.STORAGE.LOWER48", as_of=at, fetched_at=at)
    assert store.vintages().count() == 0 and store.files.names(f"{tmp_path}/s/staging") == []


def test_files_come_in_order_of_their_names(spark, tmp_path):
    for name, values in (("2024-01-02", ["5", "6"]), ("2024-01-01", ["1", "2"]), ("2024-01-03", ["9"])):
        page = lambda v: json.dumps({"response": {"data": [{"period": "2024-01-01T03", "respondent": "ERCO", "type": "D", "value": v}]}})
        (tmp_path / f"{name}.json").write_text("\n".join(map(page, values)))
    raw = spark.read.schema(landed.RECORDS).json(str(tmp_path))
    assert [r.value for r in landed.hourly_region(raw).collect()] == [9.0]  # the last fetched
    assert [r.value for r in landed.hourly_region(raw.where(~F.col("_metadata.file_name").contains("-03"))).collect()] == [6.0]
    assert [r.value for r in landed.weekly(raw.withColumn("response", F.expr("named_struct('data', transform(response.data, x -> named_struct('period', '2024-01-05', 'value', x.value)))")), "X").collect()] == [1.0]


def test_sketches_of_days_add_up(spark):
    rng = random.Random(2)
    rows = [("A" if i % 3 else "B", T0 + timedelta(minutes=i), 10.0, 10.0 + rng.expovariate(1), 10.0, 10.0, 1) for i in range(9000)]
    bars = spark.createDataFrame(rows, "Symbol string, Datetime timestamp, Open double, High double, Low double, Close double, Volume long")
    days = charts.range_sketches(bars)
    assert days.count() == 14 and days.agg(F.max(F.length("sketch"))).first()[0] < 30_000
    got = {r.Symbol: r for r in charts.distribution_of_sketches(days).collect()}
    for s in "AB":
        values = sorted((r[3] - 10) / 10 * 100 for r in rows if r[0] == s)
        assert got[s].n == len(values) and abs(got[s].low - values[0]) < 1e-9 and abs(got[s].high - values[-1]) < 1e-9
        for name, q in charts.FIVE.items():
            rank = sum(v <= got[s][name] + 1e-12 for v in values) / len(values)
            assert abs(rank - q) < 0.01
