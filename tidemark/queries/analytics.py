"""Queries of the bar audits, volatility, futures, sentiment and chart data."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.operators import charts, futures, quality, relational, sentiment, volatility
from tidemark.queries.derived import ARTICLES, BARS, CONTRACTS, NEWS, articles, bars, contracts, news, rounded, table
from tidemark.queries.holdings import scratch_store
from tidemark.sources import landed

SECTOR_SYMBOLS = ["CL=F", "BZ=F", "NG=F"]


def g01(s, d):
    return rounded(quality.price_gaps(bars(s, d), 50.0, 3600))


def g02(s, d):
    return rounded(quality.volume_anomalies(bars(s, d), 2.0))


def g03(s, d):
    return rounded(quality.price_reversals(bars(s, d), 500.0))


def g04(s, d):
    return quality.tick_quality(bars(s, d), 3600)


def h01(s, d):
    return rounded(volatility.realized(bars(s, d)).select("Symbol", "Datetime", "realized_vol"), 4)


def h02(s, d):
    return rounded(volatility.parkinson(bars(s, d)).select("Symbol", "Datetime", "parkinson_vol"), 4)


def h03(s, d):
    return rounded(volatility.garman_klass(bars(s, d)).select("Symbol", "Datetime", "garman_klass_vol"), 4)


def h04(s, d):
    df = volatility.metrics(bars(s, d))
    names = ("realized_vol", "parkinson_vol", "garman_klass_vol", "parkinson_ratio", "garman_klass_ratio", "hl_range_pct")
    return rounded(df.select("Symbol", "Datetime", *names), 4)


def h05(s, d):
    return rounded(volatility.daily_variance(bars(s, d)))


def h06(s, d):
    return rounded(volatility.daily_bars(bars(s, d)))


def h07(s, d):
    return rounded(volatility.yang_zhang(bars(s, d)))


def h08(s, d):
    return rounded(volatility.averages(bars(s, d)), 3)


def i01(s, d):
    return rounded(futures.spread(bars(s, d), "click", "view").select("Datetime", "spread", "spread_pct", "total_volume"))


def i02(s, d):
    return rounded(futures.basis(bars(s, d), "click", "view").select("Datetime", "basis", "basis_pct"))


def i03(s, d):
    c = futures.curve(contracts(s, d))
    return c.withColumn("price", F.floor(F.col("price") * 100 + 0.5))


def i04(s, d):
    df = futures.slope(futures.curve(contracts(s, d))).drop("shape")
    return rounded(df.withColumn("slope", F.nanvl("slope", F.lit(None).cast("double"))))


def i05(s, d):
    return rounded(futures.roll_yield(futures.curve(contracts(s, d))))


def i06(s, d):
    return futures.slope(futures.curve(contracts(s, d))).groupBy("Commodity", "shape").agg(F.count("*").alias("n"))


def j01(s, d):
    return sentiment.rule_scores(articles(s, d)).select("event_id", "sentiment_score", "confidence", "trade_signal")


def j02(s, d):
    return sentiment.rule_scores(articles(s, d)).groupBy("impact_sector").agg(F.count("*").alias("n"))


def j03(s, d):
    e = table(s, d, "events").select(
        "event_id", (F.col("value") - 10).alias("sentiment_score"), (F.col("value") / 5).alias("confidence"), F.col("event_type").alias("trade_signal")
    )
    return rounded(sentiment.clamped(e))


def j04(s, d):
    scored = sentiment.rule_scores(landed.with_symbols(articles(s, d), SECTOR_SYMBOLS))
    return sentiment.sentiment_rows(scored, SECTOR_SYMBOLS).select("event_id", "Symbol", "sentiment_score")


def _scores(method):
    return lambda s, d: rounded(sentiment.window_scores(news(s, d), 60, method))


def j10(s, d):
    return rounded(sentiment.prices_with_sentiment(bars(s, d), news(s, d)).select("Symbol", "Datetime", "Close", "sentiment_score", "confidence", "news_count"))


def j05(s, d):
    """Both sides on New York's clock, brought to UTC before they meet."""
    zone = "America/New_York"
    b, n = (landed.to_utc(df, "Datetime", zone) for df in (bars(s, d), news(s, d)))
    return rounded(sentiment.prices_with_sentiment(b, n).select("Symbol", "Datetime", "Close", "sentiment_score", "confidence", "news_count"))


def j06(s, d):
    """Scores are stamped with the end of their window: no article of a window is later than its stamp."""
    return sentiment.window_scores(news(s, d), 60, "mean").groupBy("window_end").agg(F.sum("news_count").alias("news_count"))


def j11(s, d):
    none = news(s, d).where(F.lit(False))
    return sentiment.prices_with_sentiment(bars(s, d), none).select("Symbol", "Datetime", "sentiment_score", "confidence", "news_count")


def j12(s, d):
    return rounded(sentiment.summary(news(s, d)))


def j12b(s, d):
    return rounded(sentiment.mean_by_symbol(news(s, d)))


def j13(s, d):
    return sentiment.headlines(news(s, d)).select("side", "news_url", "sentiment_score")


def l01(s, d):
    return rounded(charts.pct_change(bars(s, d)).select("Symbol", "Datetime", "pct_change"))


def l02(s, d):
    return rounded(charts.simple_volatility(bars(s, d)).select("Symbol", "Datetime", "realized_vol"), 3)


def l03(s, d):
    return rounded(charts.range_distribution(bars(s, d)))


def l07(s, d):
    """Five numbers of sketches by symbol and day: whether each one's rank among all ranges of the symbol is within 1 % of its own."""
    b = bars(s, d)
    five = charts.distribution_of_sketches(charts.range_sketches(b))
    asked = F.array(*(F.struct(F.lit(name).alias("number"), F.lit(q).alias("q"), F.col(name).alias("v")) for name, q in charts.FIVE.items()))
    each = five.select("Symbol", "n", F.inline(asked))
    ranges = b.select("Symbol", (F.try_divide(F.col("High") - F.col("Low"), F.col("Open")) * 100).alias("r")).where("r is not null")
    ranks = ranges.join(F.broadcast(each), "Symbol").groupBy("Symbol", "number", "n", "q").agg(F.count_if(F.col("r") < F.col("v")).alias("below"), F.count_if(F.col("r") <= F.col("v")).alias("upto"))
    near = (F.col("below") / F.col("n") - 0.01 <= F.col("q")) & (F.col("upto") / F.col("n") + 0.01 >= F.col("q"))
    return ranks.select("Symbol", "number", "n", near.alias("near"))


def l04(s, d):
    return rounded(charts.volume_profile(bars(s, d)))


def l05(s, d):
    return rounded(futures.spread(bars(s, d), "click", "view").select("Datetime", "Close", "Close_back", "spread"))


def _bar_halves(s, d):
    c = table(s, d, "customer")
    row = c.select(
        F.timestamp_seconds(F.col("c_custkey") * 60).alias("Datetime"), F.col("c_mktsegment").alias("Symbol"),
        *(F.col("c_acctbal").alias(x) for x in ("Open", "High", "Low", "Close")), F.col("c_nationkey").cast("long").alias("Volume"), "c_custkey",
    )
    old = row.where("c_custkey % 2 = 0").withColumn("Close", F.lit(0.0)).drop("c_custkey")
    new = row.where("c_custkey % 3 = 0").drop("c_custkey")
    return old, new


def f01(s, d):
    return rounded(relational.upsert_bars(*_bar_halves(s, d)).select("Symbol", "Datetime", "Close", "Volume"))


def f08(s, d):
    """The same upsert into a table in buckets by day and symbol, of which only those with new rows are rewritten."""
    bars = relational.KeyedTable(s, f"{scratch_store(s).root}/bars", relational.BAR_KEY, relational.BAR_COLUMNS, span="day", width=2)
    for half in _bar_halves(s, d):
        bars.upsert(half)
    return rounded(bars.read().select("Symbol", "Datetime", "Close", "Volume"))


def f02(s, d):
    li = table(s, d, "lineitem").groupBy("l_orderkey", "l_returnflag", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    row = li.select(
        F.timestamp_seconds(F.col("l_orderkey") * 60).alias("Datetime"), F.col("l_returnflag").alias("Commodity"),
        F.add_months(F.lit("2024-01-01").cast("date"), F.col("l_linenumber")).alias("ContractMonth"), F.lit("x").alias("Symbol"),
        *(F.col("q").alias(x) for x in ("Open", "High", "Low", "Close")), F.lit(1).cast("long").alias("Volume"), F.lit(None).cast("long").alias("OpenInterest"),
        "l_orderkey",
    )
    old = row.where("l_orderkey % 2 = 0").withColumn("Close", F.lit(-1.0)).drop("l_orderkey")
    new = row.where("l_orderkey % 4 < 2").drop("l_orderkey")
    return relational.upsert_contracts(old, new).groupBy("Commodity", "ContractMonth").agg(F.count("*").alias("n"), F.sum("Close").alias("close_sum"))


def f03(s, d):
    shuffled = bars(s, d).select("Volume", "Close", "Symbol", "Low", "Datetime", "High", "Open")
    return rounded(relational.in_order(shuffled, relational.BAR_COLUMNS))


def f04(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("t"))
    return relational.naive_to_utc(o, "t", "America/Chicago")


def f05(s, d):
    sql = "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > :least GROUP BY o_orderpriority"
    return relational.query(s, sql, {"least": 100000.0}, orders=table(s, d, "orders"))


def f06(s, d):
    return rounded(relational.recent(bars(s, d), datetime(2024, 1, 30, tzinfo=UTC), 168).select("Symbol", "Datetime", "Close"))


def f07(s, d):
    return rounded(relational.by_symbol(bars(s, d)))


_FULL = 'CASE WHEN count({x}) OVER w = {n} THEN {agg} OVER w END'
_W = 'WINDOW w AS (PARTITION BY "Symbol" ORDER BY "Datetime" ROWS BETWEEN {m} PRECEDING AND CURRENT ROW)'
_LAG = 'WINDOW o AS (PARTITION BY "Symbol" ORDER BY "Datetime")'
_R2 = 'pow(ln("High" / "Low"), 2)'
_GK = '(0.5 * pow(ln("High" / "Low"), 2) - (2 * ln(2) - 1) * pow(ln("Close" / "Open"), 2))'


def _full(x: str, agg: str, n: int) -> str:
    return _FULL.format(x=x, n=n, agg=agg)


_RETURNS = f'r AS (SELECT *, ln("Close") - lag(ln("Close")) OVER o AS lr FROM bars {_LAG})'
_METRICS = f"""{BARS}, {_RETURNS}, m AS (
  SELECT "Symbol", "Datetime", {_full('lr', 'stddev_samp(lr)', 30)} * sqrt(252 * 1440) AS rv,
         sqrt({_full('1', f'avg({_R2})', 30)} / (4 * ln(2))) * sqrt(252 * 1440) AS pk,
         {_full('1', f'avg({_GK})', 30)} AS g, CASE WHEN g >= 0 THEN sqrt(g) END * sqrt(252 * 1440) AS gk, ("High" - "Low") / "Open" * 100 AS hl
  FROM r {_W.format(m=29)})"""
_DAILY = """daily AS (
  SELECT "Symbol", "Datetime"::DATE AS date, arg_min("Open", "Datetime") AS "Open", max("High") AS "High", min("Low") AS "Low",
         arg_max("Close", "Datetime") AS "Close", sum("Volume")::BIGINT AS "Volume"
  FROM bars GROUP BY 1, 2)"""
_UP = " + ".join(f"(contains(lower(title), '{w}'))::INT" for w in sentiment.BULLISH)
_DOWN = " + ".join(f"(contains(lower(title), '{w}'))::INT" for w in sentiment.BEARISH)
_ANY = lambda words: " OR ".join(f"contains(lower(title), '{w}')" for w in words)
_SECTOR = "CASE " + " ".join(f"WHEN {_ANY(words)} THEN '{name}'" for name, words, _ in sentiment.SECTORS) + " ELSE 'General' END"
_SCORED = f"""{ARTICLES}, u AS (SELECT *, {_UP} AS up, {_DOWN} AS dn FROM articles), scored AS (
  SELECT *, CASE WHEN up > dn THEN least(0.6, 0.2 * up)::DOUBLE WHEN dn > up THEN -least(0.6, 0.2 * dn)::DOUBLE ELSE 0.0::DOUBLE END AS sentiment_score,
         0.4::DOUBLE AS confidence, CASE WHEN up > dn THEN 'LONG' WHEN dn > up THEN 'SHORT' ELSE 'NEUTRAL' END AS trade_signal,
         {_SECTOR} AS impact_sector FROM u)"""
_MATCHED = "list_filter([" + ", ".join(f"CASE WHEN {_ANY(landed.KEYWORDS[s])} THEN '{s}' END" for s in SECTOR_SYMBOLS) + "], lambda x: x IS NOT NULL)"
_END = """date_trunc('hour', "Datetime") + INTERVAL 1 HOUR"""
WINDOWS = f"""{NEWS}, w AS (
  SELECT "Symbol", {_END} AS window_end, avg(sentiment_score) AS sentiment_score, avg(confidence) AS confidence, count(*) AS news_count
  FROM news GROUP BY 1, 2)"""

ENTRIES = {
    "G01_price_gaps": (g01, f"""WITH {BARS}, x AS (
SELECT "Symbol", "Datetime", "Close", ("Close" - lag("Close") OVER o) / lag("Close") OVER o * 100 AS p,
       epoch("Datetime")::BIGINT - epoch(lag("Datetime") OVER o)::BIGINT AS gap_seconds FROM bars {_LAG})
SELECT "Symbol", "Datetime", round("Close", 6) AS "Close", round(p, 6) AS price_change_pct, gap_seconds FROM x WHERE abs(p) > 50 OR gap_seconds > 3600"""),
    "G02_volume_anomalies": (g02, f"""WITH {BARS}, x AS (SELECT "Symbol", "Datetime", "Volume", {_full('"Volume"', 'avg("Volume")', 20)} AS m,
{_full('"Volume"', 'stddev_samp("Volume")', 20)} AS sd FROM bars {_W.format(m=19)})
SELECT "Symbol", "Datetime", "Volume", round(m, 6) AS volume_mean, round(sd, 6) AS volume_std, round(("Volume" - m) / nullif(sd, 0), 6) AS z_score
FROM x WHERE abs(("Volume" - m) / nullif(sd, 0)) > 2"""),
    "G03_price_reversals": (g03, f"""WITH {BARS}, x AS (SELECT "Symbol", "Datetime", {_full('"High"', 'max("High")', 5)} AS h, {_full('"Low"', 'min("Low")', 5)} AS l
FROM bars {_W.format(m=4)})
SELECT "Symbol", "Datetime", round(h, 6) AS rolling_high, round(l, 6) AS rolling_low, round((h - l) / l * 100, 6) AS range_pct FROM x WHERE (h - l) / l * 100 > 500"""),
    "G04_tick_quality": (g04, f"""WITH {BARS}, x AS (SELECT *, epoch("Datetime") - epoch(lag("Datetime") OVER o) AS g FROM bars {_LAG})
SELECT count(*) FILTER (least("Open", "High", "Low", "Close") <= 0) AS invalid_prices,
count(*) FILTER ("High" < "Low" OR "Open" > "High" OR "Open" < "Low" OR "Close" > "High" OR "Close" < "Low") AS invalid_ohlc,
count(*) FILTER (g > 3600) AS time_gaps, count(*) AS total_records, string_agg(DISTINCT "Symbol", ',' ORDER BY "Symbol") AS symbols,
min("Datetime") AS first_time, max("Datetime") AS last_time FROM x"""),
    "H01_realized_vol": (h01, f"WITH {_METRICS} SELECT \"Symbol\", \"Datetime\", round(rv, 4) AS realized_vol FROM m"),
    "H02_parkinson": (h02, f"WITH {_METRICS} SELECT \"Symbol\", \"Datetime\", round(pk, 4) AS parkinson_vol FROM m"),
    "H03_garman_klass": (h03, f"""WITH {BARS}, x AS (SELECT "Symbol", "Datetime", {_full('1', f'avg({_GK})', 30)} AS v FROM bars {_W.format(m=29)})
SELECT "Symbol", "Datetime", round(CASE WHEN v >= 0 THEN sqrt(v) END * sqrt(252 * 1440), 4) AS garman_klass_vol FROM x"""),
    "H04_metrics": (h04, f"WITH {_METRICS} SELECT \"Symbol\", \"Datetime\", round(rv, 4) AS realized_vol, round(pk, 4) AS parkinson_vol, round(gk, 4) AS garman_klass_vol, "
                      "round(pk / nullif(rv, 0), 4) AS parkinson_ratio, round(gk / nullif(rv, 0), 4) AS garman_klass_ratio, round(hl, 4) AS hl_range_pct FROM m"),
    "H05_daily_variance": (h05, f"""WITH {BARS}, {_RETURNS}, x AS (SELECT "Symbol", "Datetime"::DATE AS date,
CASE WHEN lag("Datetime"::DATE) OVER o = "Datetime"::DATE THEN lr * lr END AS r2 FROM r {_LAG}), y AS (
SELECT "Symbol", date, coalesce(sum(r2), 0) AS v FROM x GROUP BY 1, 2)
SELECT "Symbol", date, round(v, 6) AS realized_variance, round(sqrt(v) * sqrt(252), 6) AS daily_realized_vol FROM y"""),
    "H06_daily_bars": (h06, f'WITH {BARS}, {_DAILY} SELECT * FROM daily'),
    "H07_yang_zhang": (h07, f"""WITH {BARS}, {_DAILY}, x AS (
SELECT "Symbol", ln("Open") - ln(lag("Close") OVER o) AS o, ln("Close") - ln("Open") AS c, ln("High") - ln("Open") AS h, ln("Low") - ln("Open") AS l
FROM daily WINDOW o AS (PARTITION BY "Symbol" ORDER BY date)), y AS (
SELECT "Symbol", count(*) AS n_days, var_samp(o) AS vo, var_samp(c) AS vc, avg(h * (h - c) + l * (l - c)) AS vr FROM x GROUP BY 1), z AS (
SELECT *, 0.34::DOUBLE / (1.34::DOUBLE + (n_days + 1)::DOUBLE / nullif(n_days - 1, 0)) AS k FROM y)
SELECT "Symbol", n_days, round(sqrt(vo + k * vc + (1 - k) * vr) * sqrt(252), 6) AS yang_zhang_vol FROM z"""),
    "H08_vol_averages": (h08, f"""WITH {_METRICS} SELECT "Symbol", round(avg(rv), 3) AS avg_realized_vol, round(avg(pk), 3) AS avg_parkinson_vol,
round(avg(gk), 3) AS avg_garman_klass_vol, round(avg(gk / nullif(rv, 0)), 3) AS avg_garman_klass_ratio,
round(avg(pk / nullif(rv, 0)), 3) AS avg_parkinson_ratio, round(avg(hl), 3) AS avg_hl_range_pct FROM m GROUP BY 1"""),
    "I01_spread": (i01, f"""WITH {BARS} SELECT a."Datetime", round(a."Close" - b."Close", 6) AS spread, round((a."Close" - b."Close") / b."Close" * 100, 6) AS spread_pct,
a."Volume" + b."Volume" AS total_volume FROM bars a JOIN bars b USING ("Datetime") WHERE a."Symbol" = 'click' AND b."Symbol" = 'view'"""),
    "I02_basis": (i02, f"""WITH {BARS} SELECT a."Datetime", round(a."Close" - b."Close", 6) AS basis, round((a."Close" - b."Close") / b."Close" * 100, 6) AS basis_pct
FROM bars a JOIN bars b USING ("Datetime") WHERE a."Symbol" = 'click' AND b."Symbol" = 'view'"""),
    "I03_forward_curve": (i03, f"""WITH {CONTRACTS} SELECT "Commodity", date, "ContractMonth", floor(price * 100 + 0.5)::BIGINT AS price, days_to_maturity::INTEGER AS days_to_maturity FROM curves"""),
    "I04_curve_slope": (i04, f"""WITH {CONTRACTS}, e AS (SELECT "Commodity", date, count(*) AS n_months, arg_min(price, "ContractMonth") AS f, arg_max(price, "ContractMonth") AS b,
max(days_to_maturity) - min(days_to_maturity) AS span FROM curves GROUP BY 1, 2)
SELECT "Commodity", date, n_months, round(CASE WHEN span > 0 AND f <> 0 THEN (b / f - 1) * 365 / span END, 6) AS slope FROM e"""),
    "I05_roll_yield": (i05, f"""WITH {CONTRACTS}, x AS (SELECT "Commodity", date, "ContractMonth" AS front_month, lead("ContractMonth") OVER o AS back_month, price,
lead(price) OVER o AS nxt, lead(days_to_maturity) OVER o - days_to_maturity AS span FROM curves WINDOW o AS (PARTITION BY "Commodity", date ORDER BY "ContractMonth"))
SELECT "Commodity", date, front_month, back_month, round(CASE WHEN span > 0 THEN (price / nxt - 1) * 365 / span END, 6) AS roll_yield FROM x WHERE back_month IS NOT NULL"""),
    "I06_curve_shape": (i06, f"""WITH {CONTRACTS}, e AS (SELECT "Commodity", date, arg_min(price, "ContractMonth") AS f, arg_max(price, "ContractMonth") AS b,
max(days_to_maturity) - min(days_to_maturity) AS span FROM curves GROUP BY 1, 2)
SELECT "Commodity", CASE WHEN span > 0 AND b > f THEN 'contango' WHEN span > 0 AND b < f THEN 'backwardation' ELSE 'flat' END AS shape, count(*) AS n FROM e GROUP BY 1, 2"""),
    "J01_rule_scores": (j01, f"WITH {_SCORED} SELECT event_id, sentiment_score, confidence, trade_signal FROM scored"),
    "J02_sectors": (j02, f"WITH {_SCORED} SELECT impact_sector, count(*) AS n FROM scored GROUP BY 1"),
    "J03_clamped": (j03, """SELECT event_id, round(greatest(-1, least(1, value - 10)), 6)::DOUBLE AS sentiment_score, round(greatest(0, least(1, value / 5)), 6)::DOUBLE AS confidence,
'NEUTRAL' AS trade_signal FROM events"""),
    "J04_article_symbols": (j04, f"""WITH {_SCORED}, x AS (SELECT *, {_MATCHED} AS own FROM scored)
SELECT event_id, unnest(CASE WHEN len(own) > 0 THEN own WHEN impact_sector = 'Oil' THEN ['CL=F'] WHEN impact_sector = 'Natural Gas' THEN ['NG=F']
WHEN impact_sector = 'Brent' THEN ['BZ=F'] ELSE ['CL=F', 'BZ=F', 'NG=F'] END) AS "Symbol", sentiment_score FROM x"""),
    "J05_both_sides_utc": (j05, f"""WITH {BARS}, {WINDOWS} SELECT b."Symbol", (b."Datetime" AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS "Datetime", round(b."Close", 6) AS "Close",
round(coalesce(w.sentiment_score, 0), 6) AS sentiment_score, round(coalesce(w.confidence, 0), 6) AS confidence, coalesce(w.news_count, 0) AS news_count
FROM bars b ASOF LEFT JOIN w ON b."Symbol" = w."Symbol" AND b."Datetime" >= w.window_end"""),
    "J06_window_end": (j06, f"""WITH {NEWS} SELECT date_trunc('hour', "Datetime") + INTERVAL 1 HOUR AS window_end, count(*) AS news_count FROM news GROUP BY 1"""),
    "J07_window_mean": (_scores("mean"), f"""WITH {WINDOWS} SELECT "Symbol", window_end, round(sentiment_score, 6) AS sentiment_score, round(confidence, 6) AS confidence, news_count FROM w"""),
    "J08_window_weighted": (_scores("weighted"), f"""WITH {NEWS} SELECT "Symbol", {_END} AS window_end,
round(CASE WHEN sum(confidence) <> 0 THEN sum(sentiment_score * confidence) / sum(confidence) ELSE avg(sentiment_score) END, 6) AS sentiment_score,
round(avg(confidence), 6) AS confidence, count(*) AS news_count FROM news GROUP BY 1, 2"""),
    "J09_window_latest": (_scores("latest"), f"""WITH {NEWS} SELECT "Symbol", {_END} AS window_end, round(arg_max(sentiment_score, "Datetime"), 6) AS sentiment_score,
round(arg_max(confidence, "Datetime"), 6) AS confidence, count(*) AS news_count FROM news GROUP BY 1, 2"""),
    "J10_as_of_join": (j10, f"""WITH {BARS}, {WINDOWS} SELECT b."Symbol", b."Datetime", round(b."Close", 6) AS "Close", round(coalesce(w.sentiment_score, 0), 6) AS sentiment_score,
round(coalesce(w.confidence, 0), 6) AS confidence, coalesce(w.news_count, 0) AS news_count
FROM bars b ASOF LEFT JOIN w ON b."Symbol" = w."Symbol" AND b."Datetime" >= w.window_end"""),
    "J11_no_news": (j11, f'WITH {BARS} SELECT "Symbol", "Datetime", NULL::DOUBLE AS sentiment_score, NULL::DOUBLE AS confidence, 0::BIGINT AS news_count FROM bars'),
    "J12_news_summary": (j12, f"""WITH {NEWS} SELECT count(DISTINCT news_url) AS total_articles, count(*) FILTER (sentiment_score > 0.3) AS bullish,
count(*) FILTER (sentiment_score BETWEEN -0.3 AND 0.3) AS neutral, count(*) FILTER (sentiment_score < -0.3) AS bearish,
round(avg(confidence), 6) AS avg_confidence, min("Datetime") AS first_time, max("Datetime") AS last_time FROM news"""),
    "J12_news_by_symbol": (j12b, f'WITH {NEWS} SELECT "Symbol", round(avg(sentiment_score), 6) AS avg_sentiment FROM news GROUP BY 1'),
    "J13_headlines": (j13, f"""WITH {NEWS}, o AS (SELECT news_url, max(sentiment_score) AS sentiment_score FROM news GROUP BY 1)
(SELECT 'bullish' AS side, news_url, sentiment_score FROM o ORDER BY sentiment_score DESC, news_url LIMIT 3) UNION ALL
(SELECT 'bearish' AS side, news_url, sentiment_score FROM o ORDER BY sentiment_score, news_url LIMIT 3)"""),
    "L01_pct_change": (l01, f'WITH {BARS} SELECT "Symbol", "Datetime", round("Close" / lag("Close") OVER o - 1, 6) AS pct_change FROM bars {_LAG}'),
    "L02_simple_vol": (l02, f"""WITH {BARS}, p AS (SELECT *, "Close" / lag("Close") OVER o - 1 AS pc FROM bars {_LAG})
SELECT "Symbol", "Datetime", round({_full('pc', 'stddev_samp(pc)', 30)} * sqrt(252 * 1440), 3) AS realized_vol FROM p {_W.format(m=29)}"""),
    "L03_range_distribution": (l03, f"""WITH {BARS}, x AS (SELECT "Symbol", ("High" - "Low") / "Open" * 100 AS r FROM bars)
SELECT "Symbol", round(min(r), 6) AS low, round(quantile_cont(r, 0.25), 6) AS q1, round(quantile_cont(r, 0.5), 6) AS median, round(quantile_cont(r, 0.75), 6) AS q3,
round(max(r), 6) AS high, count(r) AS n FROM x GROUP BY 1"""),
    "L07_range_sketches": (l07, f"""WITH {BARS} SELECT "Symbol", number, count(*) AS n, TRUE AS near FROM bars, (VALUES ('low'), ('q1'), ('median'), ('q3'), ('high')) f(number)
WHERE "Open" <> 0 GROUP BY 1, 2"""),
    "L04_volume_profile": (l04, f"""WITH {BARS}, e AS (SELECT "Symbol", min("Close") AS lo, (max("Close") - min("Close")) / 50 AS width FROM bars GROUP BY 1), x AS (
SELECT "Symbol", coalesce(least(floor(("Close" - lo) / nullif(width, 0)), 49), 0)::INTEGER AS bin, "Volume", lo, width FROM bars JOIN e USING ("Symbol"))
SELECT "Symbol", bin, round(min(lo) + bin * min(width), 6) AS price_from, sum("Volume")::BIGINT AS volume FROM x GROUP BY 1, 2"""),
    "L05_spread_series": (l05, f"""WITH {BARS} SELECT a."Datetime", round(a."Close", 6) AS "Close", round(b."Close", 6) AS "Close_back", round(a."Close" - b."Close", 6) AS spread
FROM bars a JOIN bars b USING ("Datetime") WHERE a."Symbol" = 'click' AND b."Symbol" = 'view'"""),
    "F01_upsert_bars": (f01, """SELECT c_mktsegment AS "Symbol", (to_timestamp(c_custkey * 60) AT TIME ZONE 'UTC')::TIMESTAMP AS "Datetime",
round(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0 END, 6)::DOUBLE AS "Close", c_nationkey::BIGINT AS "Volume" FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0"""),
    "F08_incremental_upsert": (f08, """SELECT c_mktsegment AS "Symbol", (to_timestamp(c_custkey * 60) AT TIME ZONE 'UTC')::TIMESTAMP AS "Datetime",
round(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE 0 END, 6)::DOUBLE AS "Close", c_nationkey::BIGINT AS "Volume" FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0"""),
    "F02_upsert_contracts": (f02, """WITH li AS (SELECT l_orderkey, l_returnflag, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag AS "Commodity", (DATE '2024-01-01' + to_months(l_linenumber))::DATE AS "ContractMonth", count(*) AS n,
sum(CASE WHEN l_orderkey % 4 < 2 THEN q ELSE -1 END)::DOUBLE AS close_sum FROM li WHERE l_orderkey % 2 = 0 OR l_orderkey % 4 < 2 GROUP BY 1, 2"""),
    "F03_column_order": (f03, f'WITH {BARS} SELECT "Datetime", "Symbol", "Open", "High", "Low", "Close", "Volume" FROM bars'),
    "F04_naive_to_utc": (f04, """SELECT o_orderkey, (o_orderdate AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' AS t FROM orders"""),
    "F05_free_sql": (f05, "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000.0 GROUP BY o_orderpriority"),
    "F06_recent": (f06, f"""WITH {BARS} SELECT "Symbol", "Datetime", round("Close", 6) AS "Close" FROM bars WHERE "Datetime" >= TIMESTAMP '2024-01-30' - INTERVAL 168 HOUR"""),
    "F07_by_symbol": (f07, f"""WITH {BARS} SELECT "Symbol", count(*) AS n_rows, min("Datetime") AS first_time, max("Datetime") AS last_time, round(avg("Close"), 6) AS avg_close,
sum("Volume")::BIGINT AS total_volume FROM bars GROUP BY 1"""),
}
