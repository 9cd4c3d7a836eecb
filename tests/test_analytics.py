"""Analytics against hand-computed values."""

import math
from datetime import UTC, date, datetime, timedelta

import pytest

from tidemark import functions
from tidemark.operators import charts, futures, observe, quality, relational, sentiment, volatility

T0 = datetime(2024, 1, 2, 14, 30, tzinfo=UTC)
BAR = "Datetime timestamp, Symbol string, Open double, High double, Low double, Close double, Volume long"


def intraday(spark):
    rows = [
        (T0 + timedelta(minutes=i), s, p + 0.1 * i, p + 0.1 * i + 0.2, p + 0.1 * i - 0.2, p + 0.1 * i + 0.05, 1000 + 10 * i)
        for s, p in (("CL=F", 75.0), ("NG=F", 2.5))
        for i in range(30)
    ]
    return spark.createDataFrame(rows, BAR)


def closes(spark, days):
    rows = []
    for k, values in enumerate(days):
        for i, c in enumerate(values):
            rows.append((datetime(2024, 1, 2 + k, 14, i, tzinfo=UTC), "X", float(c), c + 0.5, c - 0.5, float(c), 100))
    return spark.createDataFrame(rows, BAR)


def test_realised_vol_is_null_until_the_window_is_full(spark):
    got = volatility.realized(intraday(spark), window=5).orderBy("Symbol", "Datetime").collect()
    vols = [r.realized_vol for r in got if r.Symbol == "CL=F"]
    assert vols[:5] == [None] * 5 and all(v is not None for v in vols[5:])


def test_daily_variance_leaves_out_the_night(spark):
    one = volatility.daily_variance(closes(spark, [[100, 101, 100, 102]])).first()
    want = sum(math.log(b / a) ** 2 for a, b in ((100, 101), (101, 100), (100, 102)))
    assert one.realized_variance == pytest.approx(want)
    two = {r.date: r.realized_variance for r in volatility.daily_variance(closes(spark, [[100, 101], [200, 202]])).collect()}
    assert two[date(2024, 1, 3)] == pytest.approx(math.log(202 / 200) ** 2)


def test_daily_bars(spark):
    r = volatility.daily_bars(closes(spark, [[100, 105, 95, 102]])).first()
    assert (r.Open, r.High, r.Low, r.Close, r.Volume) == (100, 105.5, 94.5, 102, 400)


def test_yang_zhang(spark):
    six = closes(spark, [[100 + d, 101 + d, 99 + d, 102 - d] for d in range(6)])
    r = volatility.yang_zhang(six).first()
    assert r.n_days == 6 and r.yang_zhang_vol > 0 and math.isfinite(r.yang_zhang_vol)
    assert volatility.yang_zhang(closes(spark, [[100, 101]])).first().yang_zhang_vol is None


def test_metrics_ratio_and_chart_vol(spark):
    assert volatility.metrics(intraday(spark), 5).where("parkinson_ratio is not null").count() > 0
    assert charts.simple_volatility(intraday(spark), 5).where("realized_vol is not null").count() == 2 * 25
    assert charts.volume_profile(intraday(spark)).groupBy().sum("volume").first()[0] == 2 * sum(1000 + 10 * i for i in range(30))


def test_quality(spark):
    q = quality.tick_quality(intraday(spark)).first()
    assert (q.invalid_prices, q.invalid_ohlc, q.total_records, q.symbols) == (0, 0, 60, "CL=F,NG=F")
    bad = spark.createDataFrame([(T0, "X", 1.0, 2.0, 0.5, 1.0, 1), (T0 + timedelta(minutes=1), "X", 1.0, 0.5, 2.0, 1.02, 1)], BAR)
    assert quality.tick_quality(bad).first().invalid_ohlc == 1
    assert quality.price_gaps(bad, 1.0).count() == 1 and quality.price_gaps(bad, 5.0).count() == 0


def test_flat_volume_flags_nothing(spark):
    flat = spark.createDataFrame([(T0 + timedelta(minutes=i), "X", 1.0, 1.0, 1.0, 1.0, 5) for i in range(40)], BAR)
    assert quality.volume_anomalies(flat, 1.0).count() == 0


def strip(spark):
    rows = [
        (datetime(2024, 1, 2 + d, tzinfo=UTC), c, date(2024, 2 + m, 1), p + s * m)
        for d in range(2)
        for c, p, s in (("crude", 80.0, -0.5), ("gas", 2.0, 0.05))
        for m in range(6)
    ]
    return spark.createDataFrame(rows, "Datetime timestamp, Commodity string, ContractMonth date, Close double")


def test_curves(spark):
    curves = futures.curve(strip(spark))
    first = curves.where("Commodity = 'crude' and date = '2024-01-02'").orderBy("ContractMonth").collect()
    assert len(first) == 6 and first[0].days_to_maturity == 30
    shapes = {(r.Commodity, r.date): (r.shape, r.slope) for r in futures.slope(curves).collect()}
    assert shapes["crude", date(2024, 1, 2)][0] == "backwardation" and shapes["gas", date(2024, 1, 2)][0] == "contango"
    rolls = futures.roll_yield(curves).where("date = '2024-01-02'").collect()
    assert sum(r.Commodity == "crude" and r.roll_yield > 0 for r in rolls) == 5
    assert sum(r.Commodity == "gas" and r.roll_yield < 0 for r in rolls) == 5
    single = futures.slope(curves.where("ContractMonth = '2024-02-01'")).first()
    assert math.isnan(single.slope) and single.shape == "flat"


def test_spread(spark):
    assert futures.spread(intraday(spark), "CL=F", "NG=F").count() == 30


NEWS = "Datetime timestamp, Symbol string, news_title string, news_url string, sentiment_score double, confidence double"


def test_news_reaches_only_later_bars(spark):
    bars = spark.createDataFrame([(datetime(2024, 1, 2, 10, 15, tzinfo=UTC), "CL=F", 1.0), (datetime(2024, 1, 2, 11, 0, tzinfo=UTC), "CL=F", 1.0)], "Datetime timestamp, Symbol string, Close double")
    news = spark.createDataFrame([(datetime(2024, 1, 2, 10, 45, tzinfo=UTC), "CL=F", "t", "u", 0.8, 0.9)], NEWS)
    got = sentiment.prices_with_sentiment(bars, news).orderBy("Datetime").collect()
    assert [r.sentiment_score for r in got] == [0.0, 0.8] and [r.news_count for r in got] == [0, 1]
    none = sentiment.prices_with_sentiment(bars, news.where("false")).first()
    assert none.sentiment_score is None and none.news_count == 0


def test_weighted_mean_without_confidence_is_the_mean(spark):
    at = datetime(2024, 1, 2, 10, 45, tzinfo=UTC)
    news = spark.createDataFrame([(at, "A", "t", "u", 0.8, 0.0), (at, "A", "t", "v", 0.2, 0.0), (at, "B", "t", "u", 1.0, 1.0), (at, "B", "t", "v", 0.0, 0.0)], NEWS)
    got = {r.Symbol: r.sentiment_score for r in sentiment.window_scores(news, 60, "weighted").collect()}
    assert got == {"A": pytest.approx(0.5), "B": pytest.approx(1.0)}


def test_rules_sectors_and_symbols(spark):
    rows = [("Crude oil rally on production cut", None, None), ("Gasoline glut", None, None), ("Nothing", "new", ["BZ=F"])]
    scored = sentiment.rule_scores(spark.createDataFrame(rows, "title string, summary string, symbols array<string>"))
    got = {r.title: r for r in scored.collect()}
    assert got["Crude oil rally on production cut"].sentiment_score == pytest.approx(0.4)
    assert got["Gasoline glut"].trade_signal == "SHORT" and got["Gasoline glut"].impact_sector == "Natural Gas"
    targets = {(r.title, r.Symbol) for r in sentiment.sentiment_rows(scored, ["CL=F", "NG=F", "BZ=F"]).collect()}
    assert targets == {("Crude oil rally on production cut", "CL=F"), ("Gasoline glut", "NG=F"), ("Nothing", "BZ=F")}


def test_upsert(spark):
    old = intraday(spark)
    again = relational.upsert_bars(old, old)
    assert again.count() == 60
    new = old.where("Symbol = 'CL=F'").withColumn("Close", old.Close + 1).select("Volume", "Close", "Symbol", "Low", "Datetime", "High", "Open")
    got = relational.upsert_bars(old, new)
    assert got.count() == 60 and got.columns == list(relational.BAR_COLUMNS)
    assert got.where("Symbol = 'CL=F'").orderBy("Datetime").first().Close == pytest.approx(76.05)
    with pytest.raises(ValueError, match="missing columns: Close"):
        relational.upsert_bars(old, new.drop("Close"))


def uneven(spark):
    """Bars of two symbols with empty hours, full hours and rows without a time."""
    at = [0, 1, 2, 3, 200, 201, 500, 501, 502, 503, 504, 505, 506, 507, 508, 900, 1000, 1100, 1200, 1201, 1202, 1300, 2900, 2901, 2902, 3000]
    rows = []
    for s, step in (("A", 1), ("B", 2)):
        for i, m in enumerate(at[::step]):
            c = 100 + (i * 7919 + step * 31) % 23
            rows.append((T0 + timedelta(minutes=m), s, c - 1.0, c + 3.0 + i % 3, c - 4.0, float(c), 100 + (i * i) % 50))
    rows.append((None, "A", 1.0, 2.0, 1.0, 1.5, 3))
    rows.append((T0, None, 1.0, 2.0, 1.0, 1.5, 3))
    return spark.createDataFrame(rows, BAR)


@pytest.mark.parametrize("size", [1, 2, 5, 9])
def test_windows_are_the_same_whatever_the_block(spark, monkeypatch, size):
    jobs = (
        lambda b: volatility.metrics(b, 4), lambda b: volatility.realized(b, 7), lambda b: charts.simple_volatility(b, 3), charts.pct_change,
        lambda b: quality.price_gaps(b, 5.0), lambda b: quality.volume_anomalies(b, 0.5, 5), lambda b: quality.price_reversals(b, 2.0, 6),
        quality.tick_quality, lambda b: observe.cadence_gaps(b, "Symbol", "Datetime"),
    )
    bars = uneven(spark)
    whole = [sorted(map(str, job(bars).collect())) for job in jobs]
    monkeypatch.setattr(functions, "BLOCK_ROWS", size)
    assert functions.in_blocks(bars, 3).select("Symbol", "_block").distinct().count() > 4
    assert functions.own_rows(functions.in_blocks(bars, 3)).count() == bars.count()
    assert [sorted(map(str, job(bars).collect())) for job in jobs] == whole


def test_scores_are_carried_over_days(spark):
    bars = uneven(spark)
    minutes = ((-4000, "A"), (0, "A"), (499, "A"), (505, "A"), (2901, "B"))
    stamps = [(s, T0 + timedelta(minutes=m), float(i + 1), 0.5, i + 1) for i, (m, s) in enumerate(minutes)]
    scores = spark.createDataFrame(stamps, "Symbol string, window_end timestamp, sentiment_score double, confidence double, news_count long")
    got = sentiment.as_of_join(bars, scores).collect()
    assert len(got) == bars.count()
    for r in got:
        before = [x for x in stamps if r.Datetime and x[0] == r.Symbol and x[1] <= r.Datetime.replace(tzinfo=UTC)]
        assert r.sentiment_score == (max(before, key=lambda x: x[1])[2] if before else 0)
