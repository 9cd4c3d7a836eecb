"""Queries of the payload shapes and the pipelines, on payloads that Spark derives from the given tables."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.pipelines import ingest, read_back
from tidemark.queries.derived import ARTICLES, BARS, HEADLINES, articles, bars, rounded, table
from tidemark.queries.holdings import scratch_store
from tidemark.sources import landed

AT = datetime(2024, 2, 1, tzinfo=UTC)


#: Events of an envelope at most, so that no row grows with the table.
ENVELOPE = 1000


def _envelope():
    return F.floor(F.col("event_id") / ENVELOPE)


def _payload(s: SparkSession, d: str, fmt: str, extra: dict) -> DataFrame:
    """JSON envelopes of up to ``ENVELOPE`` events, read back with the declared schema; ``_order`` is that of their ids."""
    e = table(s, d, "events")
    record = F.struct(F.date_format("ts", fmt).alias("period"), *(c.alias(k) for k, c in extra.items()))
    days = e.groupBy(_envelope().alias("_order")).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("i"), record.alias("r")))).alias("a"))
    text = days.select("_order", F.to_json(F.struct(F.struct(F.transform("a", lambda x: x["r"]).alias("data")).alias("response"))).alias("t"))
    return text.select("_order", F.from_json("t", landed.RECORDS).alias("j")).select("_order", "j.*")


_BAD = "n/a"


def _value():
    return F.when(F.col("event_id") % 13 == 0, F.lit(_BAD)).when(F.col("event_id") % 17 == 0, F.lit("NaN")).otherwise(F.format_string("%.2f", F.col("value")))


def a01(s, d):
    return rounded(landed.weekly(_payload(s, d, "yyyy-MM-dd", {"value": _value()}), "EIA.NG.STORAGE.LOWER48"))


def a02(s, d):
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.upper("event_type"), "type": F.lit("D"), "value": _value()})
    return rounded(landed.hourly_region(raw))


def a03(s, d):
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.lit("ERCO"), "fueltype": F.upper("event_type"), "value": _value()})
    return rounded(landed.hourly_by_fuel(raw))


def a04(s, d):
    e = table(s, d, "events")
    return e.select("event_id", landed.hour(F.date_format("ts", "yyyy-MM-dd'T'HH")).alias("valid_time"))


def _report(s, d, fields: dict) -> DataFrame:
    """Paged envelopes of order rows: arrays of text, and the list of their fields."""
    o = table(s, d, "orders")
    row = F.array(*fields.values())
    pages = o.groupBy((F.col("o_orderkey") / 1000).cast("int").alias("_order")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("i"), row.alias("r")))).alias("a")
    )
    names = F.array(*(F.struct(F.lit(n).alias("name")) for n in fields))
    text = pages.select("_order", F.to_json(F.struct(F.transform("a", lambda x: x["r"]).alias("data"), names.alias("fields"))).alias("t"))
    return text.select("_order", F.from_json("t", landed.REPORT).alias("j")).select("_order", "j.*")


def _day():
    """Order dates, Sundays moved to Monday: clocks change on Sundays, and DuckDB has its own rule for repeated hours."""
    return F.to_date("o_orderdate") + F.when(F.dayofweek("o_orderdate") == 1, 1).otherwise(0)


_POINTS = ("HB_NORTH", "LZ_WEST", "HB_OTHER", "RESOURCE_1", "LZ_SOUTH")


def _point():
    return F.get(F.array(*map(F.lit, _POINTS)), (F.col("o_orderkey") % 5).cast("int"))


def _price():
    return F.when(F.col("o_orderkey") % 11 == 0, F.lit("NaN")).otherwise(F.format_string("%.2f", F.col("o_totalprice") / 1000))


def _real_time(s, d):
    return _report(s, d, {
        "deliveryDate": F.date_format(_day(), "yyyy-MM-dd"), "deliveryHour": (F.col("o_orderkey") % 24 + 1).cast("string"),
        "deliveryInterval": (F.col("o_orderkey") % 4 + 1).cast("string"), "settlementPoint": _point(),
        "settlementPointPrice": _price(), "DSTFlag": F.lit("false"),
    })


def _hourly_report(s, d, day: str, more: dict):
    return _report(s, d, {
        day: F.date_format(_day(), "yyyy-MM-dd"), "hourEnding": F.format_string("%02d:00", F.col("o_orderkey") % 24 + 1), **more, "DSTFlag": F.lit("false"),
    })


def a05(s, d):
    rows = landed.report_rows(_real_time(s, d))
    return rows.select(F.col("m")["settlementPoint"].alias("settlement_point"), F.col("m")["deliveryHour"].cast("int").alias("hour")).groupBy("settlement_point", "hour").agg(F.count("*").alias("n"))


def a06(s, d):
    return rounded(landed.real_time_prices(_real_time(s, d)), 2)


def a07(s, d):
    return rounded(landed.day_ahead_prices(_day_ahead(s, d)), 2)


def _day_ahead(s, d):
    return _hourly_report(s, d, "deliveryDate", {"settlementPoint": _point(), "settlementPointPrice": _price()})


def a08(s, d):
    return rounded(landed.system_load(_load(s, d)), 2)


def _load(s, d):
    return _hourly_report(s, d, "operatingDay", {"coast": F.lit("1"), "total": F.when(F.col("o_orderkey") % 11 == 0, F.lit("NaN")).otherwise(F.floor(F.col("o_totalprice") / 10).cast("string"))})


def a09(s, d):
    from tidemark.functions import local_ending_to_utc

    o = table(s, d, "orders")
    end = (F.col("o_orderkey") % 24 + 1).cast("int") * 60
    return o.select("o_orderkey", local_ending_to_utc(_day(), end, F.lit(True), 60, landed.CENTRAL).alias("valid_time"))


def a10(s, d):
    from tidemark.functions import hour_ending_minutes

    o = table(s, d, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("late")).otherwise(F.format_string("%02d:00", F.col("o_orderkey") % 24 + 1))
    return o.select("o_orderkey", hour_ending_minutes(text).alias("minutes"))


def a11(s, d):
    return landed.real_time_prices(_real_time(s, d)).groupBy("settlement_point").agg(F.count("*").alias("n"))


def a12(s, d):
    return landed.unlisted_points(_real_time(s, d))


def _spot(s, d, ids):
    e = table(s, d, "events")
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col("event_id") % 5 == 0, F.lit(".")).when(F.col("event_id") % 17 == 0, F.lit("NaN")).otherwise(F.format_string("%.2f", "value")).alias("value"))
    some = e.groupBy(ids.alias("instrument_id"), _envelope().alias("_order")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("i"), rec.alias("r")))).alias("a")
    )
    raw = some.select("instrument_id", "_order", F.from_json(F.to_json(F.struct(F.transform("a", lambda x: x["r"]).alias("observations"))), landed.OBSERVATIONS).alias("j"))
    return raw.select("instrument_id", "_order", "j.*")


def a13(s, d):
    raw = _spot(s, d, F.concat(F.lit("FRED."), F.upper("event_type"), F.lit(".SPOT")))
    return rounded(landed.spot(raw, F.col("instrument_id")))


def a14(s, d):
    o = table(s, d, "orders").select(F.concat(F.lit("climdiv-hddcst-v1.0.0-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("name"))
    return landed.newest_file(o, "hddcst")


def _lines(s, d, element: str, once: bool = False) -> DataFrame:
    """Fixed-width lines: a region and one of 8000 years for each order; with ``once`` the greatest quantity of the orders that meet in one."""
    codes = F.array(*map(F.lit, ("110", "101", "041", "999")))
    li = table(s, d, "lineitem").groupBy((F.col("l_orderkey") % 8000 if once else F.col("l_orderkey")).alias("l_orderkey")).agg(F.max("l_quantity").alias("q"))
    code = F.get(codes, (F.col("l_orderkey") % 4).cast("int"))
    cells = [F.lpad(F.when((F.col("l_orderkey") + m) % 9 == 0, F.lit("-9999.")).otherwise(F.format_string("%.0f.", F.col("q") + m)), 7, " ") for m in range(12)]
    return li.select(F.concat(code, F.lit("0"), F.lit(element), F.format_string("%04d", F.col("l_orderkey") % 8000 + 1000), *cells).alias("value"))


def a15(s, d):
    return landed.degree_days(_lines(s, d, "25"), "25", "hdd")


def a16(s, d):
    return landed.both_degree_days(landed.degree_days(_lines(s, d, "25", True).where("value not like '110%'"), "25", "hdd"), landed.degree_days(_lines(s, d, "26", True), "26", "cdd"))


def a17(s, d):
    b = bars(s, d).withColumn("Volume", F.when(F.col("Volume") == 1, F.lit(None)).otherwise(F.col("Volume")))
    return rounded(landed.bars(b, F.concat(F.lit("CME."), "Symbol")))


#: A contract for each type of event.
_TICKERS = {"click": "CLF24", "error": "CLG24", "purchase": "CLH24", "signup": "NGF24", "view": "NGG24"}


def a18(s, d):
    b = bars(s, d)
    return rounded(landed.commodity_bars(*(b.where(F.col("Symbol") == kind) for kind in _TICKERS)))


_ROOTS = {"crude": "CL", "gas": "NG"}


def a19(s, d):
    """The calendar, joined to the tickers that orders of a month would trade."""
    cal = landed.contract_calendar(s, _ROOTS, date(1995, 1, 15), 24)
    o = table(s, d, "orders").select(F.trunc("o_orderdate", "month").alias("ContractMonth"))
    return o.join(F.broadcast(cal), "ContractMonth").groupBy("Commodity", "ContractMonth", "ticker").agg(F.count("*").alias("n"))


def a20(s, d):
    cal = landed.contract_calendar(s, _ROOTS, date(2024, 1, 1), 3)
    names = F.create_map(*(F.lit(x) for kv in _TICKERS.items() for x in kv))
    raw = bars(s, d).withColumn("ticker", names[F.col("Symbol")]).drop("Symbol")
    return rounded(landed.contract_bars(raw, cal).select("Datetime", "Commodity", "ContractMonth", "Symbol", "Close", "Volume", "OpenInterest"))


def a21(s, d):
    return landed.to_utc(table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("t")), "t", "America/New_York")


def a22(s, d):
    return landed.recent_articles(articles(s, d), datetime(2024, 1, 20, tzinfo=UTC), AT).select("event_id", "published_at")


def a23(s, d):
    return landed.with_symbols(articles(s, d), ["CL=F", "BZ=F", "NG=F", "MARKETS"]).select("event_id", F.array_join("symbols", ",").alias("symbols"))


def a24(s, d):
    a = articles(s, d).select("url", "title", F.col("published").alias("published_at"), "source")
    return landed.all_articles(a.where("source = 'click'"), a.where("source <> 'click'")).select("url", "published_at")


def a25(s, d):
    b = bars(s, d)
    start = datetime(2024, 1, 20, tzinfo=UTC)
    return landed.window_of(b, start, AT, "hourly", "Datetime").groupBy("Symbol").agg(F.count("*").alias("n"), F.min("Datetime").alias("first_time"))


# -- pipelines ----------------------------------------------------------------


def _pipeline(name: str, library: str, raw, at: datetime = datetime(2024, 1, 31, tzinfo=UTC)):
    def run(s, d):
        store = scratch_store(s)
        ingest(store, name, *raw(s, d), as_of=at, fetched_at=at)
        rows = store.read(library)
        bad = read_back(store, name, library).agg(F.count("*").alias("n_failures"))
        return rows.groupBy("library", "symbol").agg(F.count("*").alias("n")).join(F.broadcast(bad))

    return run


def e01(s, d):
    """Five types of events are three instruments: bars of two types in an hour become one."""
    kinds = {"click": "CL", "purchase": "CL", "view": "BZ", "signup": "BZ", "error": "NG"}
    names = F.create_map(*(F.lit(x) for k, v in kinds.items() for x in (k, f"CME.{v}.FRONT")))
    b = bars(s, d).groupBy(names[F.col("Symbol")].alias("id"), "Datetime").agg(
        F.min_by("Open", "Symbol").alias("Open"), F.max("High").alias("High"), F.min("Low").alias("Low"), F.max_by("Close", "Symbol").alias("Close"), F.sum("Volume").alias("Volume"),
    )
    return _pipeline("intraday_bars", "prices.intraday", lambda *_: (b, F.col("id")))(s, d)


def e02(s, d):
    series = F.when(F.col("event_id") % 3 == 0, F.lit("FRED.WTI.SPOT")).when(F.col("event_id") % 3 == 1, F.lit("FRED.BRENT.SPOT")).otherwise(F.lit("FRED.HENRYHUB.SPOT"))
    return _pipeline("spot_prices", "prices.spot", lambda *_: (_spot(s, d, series), F.col("instrument_id")))(s, d)


def e03(s, d):
    """Degree days of three regions, 2000 to 2024: each order in one of the years, the greatest quantity of those that meet in one."""
    li = table(s, d, "lineitem").groupBy((F.col("l_orderkey") % 100).alias("l_orderkey")).agg(F.max("l_quantity").alias("q"))
    code = F.get(F.array(*map(F.lit, ("110", "101", "041", "999"))), (F.col("l_orderkey") % 4).cast("int"))
    cells = [F.lpad(F.format_string("%.0f.", F.col("q") + m), 7, " ") for m in range(12)]
    lines = lambda e: li.select(F.concat(code, F.lit("0"), F.lit(e), F.format_string("%04d", F.floor(F.col("l_orderkey") / 4) + 2000), *cells).alias("value"))
    both = landed.degree_days(lines("25"), "25", "hdd"), landed.degree_days(lines("26"), "26", "cdd")
    return _pipeline("degree_days", "weather", lambda *_: both, datetime(2025, 1, 6, tzinfo=UTC))(s, d)


#: The day after the newest order.
AFTER = datetime(2001, 8, 2, tzinfo=UTC)


def e08(s, d):
    return _pipeline("real_time_prices", "power.lmp", lambda *_: (_real_time(s, d),), AFTER)(s, d)


def e09(s, d):
    return _pipeline("day_ahead_prices", "power.dalmp", lambda *_: (_day_ahead(s, d),), AFTER)(s, d)


def e10(s, d):
    return _pipeline("system_load", "power.load", lambda *_: (_load(s, d),), AFTER)(s, d)


def c11(s, d):
    """Committed rows read back through their gate long after: they are stale, and nothing else is wrong with them."""
    store = scratch_store(s)
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.upper("event_type"), "type": F.lit("D"), "value": _value()})
    ingest(store, "hourly_region", raw, as_of=datetime(2024, 1, 31, tzinfo=UTC), fetched_at=AT)
    return read_back(store, "hourly_region", "power.demand", datetime(2024, 3, 1, tzinfo=UTC))


def e04(s, d):
    raw = _payload(s, d, "yyyy-MM-dd", {"value": _value()})
    return _pipeline("gas_storage", "fundamentals.eia", lambda *_: (raw, "EIA.NG.STORAGE.LOWER48"))(s, d)


def e05(s, d):
    raw = _payload(s, d, "yyyy-MM-dd", {"value": _value()})
    return _pipeline("crude_stocks", "fundamentals.eia", lambda *_: (raw, "EIA.PET.CRUDE.STOCKS"))(s, d)


def e06(s, d):
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.upper("event_type"), "type": F.lit("D"), "value": _value()})
    return _pipeline("hourly_region", "power.demand", lambda *_: (raw,))(s, d)


def e07(s, d):
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.lit("ERCO"), "fueltype": F.upper("event_type"), "value": _value()})
    return _pipeline("hourly_by_fuel", "power.generation_by_fuel", lambda *_: (raw,))(s, d)


def e11(s, d):
    store = scratch_store(s)
    raw = _payload(s, d, "yyyy-MM-dd'T'HH", {"respondent": F.upper("event_type"), "type": F.get(F.array(F.lit("D"), F.lit("NG")), (F.col("event_id") % 2).cast("int")), "value": _value()})
    return ingest(store, "hourly_region", raw, as_of=datetime(2024, 1, 31, tzinfo=UTC), fetched_at=AT)


_V = "CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE round(value, 2) END"
_ORDERS = f"""o AS (SELECT o_orderkey, o_orderdate::DATE + CASE WHEN dayofweek(o_orderdate) = 0 THEN 1 ELSE 0 END AS day, o_totalprice, (['HB_NORTH', 'LZ_WEST', 'HB_OTHER', 'RESOURCE_1', 'LZ_SOUTH'])[o_orderkey % 5 + 1] AS point,
  o_orderkey % 24 + 1 AS hour, o_orderkey % 4 + 1 AS quarter FROM orders)"""


def _instant(begin: str, minutes: int) -> str:
    return f"(((day + to_minutes(({begin})::INTEGER)) AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' + INTERVAL {minutes} MINUTE)"


_LAST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY o_orderkey DESC) = 1"
_QUARTER, _HOUR = _instant("(hour - 1) * 60 + (quarter - 1) * 15", 15), _instant("(hour - 1) * 60", 60)
_PRICES = f"""{_ORDERS}, rt AS (SELECT point, {_QUARTER} AS valid_time, round(o_totalprice / 1000, 2) AS price FROM o
  WHERE o_orderkey % 11 <> 0 AND point IN ('HB_NORTH', 'LZ_WEST', 'LZ_SOUTH') {_LAST.format(key="point, " + _QUARTER)}),
da AS (SELECT point, {_HOUR} AS valid_time, round(o_totalprice / 1000, 2) AS price FROM o
  WHERE o_orderkey % 11 <> 0 AND point IN ('HB_NORTH', 'LZ_WEST', 'LZ_SOUTH') {_LAST.format(key="point, " + _HOUR)}),
load AS (SELECT {_HOUR} AS valid_time, floor(o_totalprice / 10)::DOUBLE AS value FROM o WHERE o_orderkey % 11 <> 0 {_LAST.format(key=_HOUR)})"""
_CELLS = """cells AS (SELECT 'NOAA.HDD.' || (['CONUS', 'NORTHEAST', 'TEXAS'])[l_orderkey % 4 + 1] AS instrument_id, make_timestamp(1000 + l_orderkey % 8000, m + 1, 1, 0, 0, 0) AS valid_time,
  CASE WHEN (l_orderkey + m) % 9 = 0 THEN NULL ELSE round(q + m)::DOUBLE END AS v FROM li, range(12) r(m) WHERE l_orderkey % 4 < 3)"""
_LINES = f"li AS (SELECT l_orderkey, max(l_quantity) AS q FROM lineitem GROUP BY 1), {_CELLS}"
_LINES_ONCE = f"li AS (SELECT l_orderkey % 8000 AS l_orderkey, max(l_quantity) AS q FROM lineitem GROUP BY 1), {_CELLS}"
_MATCH = "list_filter([" + ", ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(title), '{w}')" for w in landed.KEYWORDS.get(s, (s.lower(),))) + f" THEN '{s}' END"
    for s in ("CL=F", "BZ=F", "NG=F", "MARKETS")
) + "], lambda x: x IS NOT NULL)"

ENTRIES = {
    "A01_weekly": (a01, f"""SELECT 'EIA.NG.STORAGE.LOWER48' AS instrument_id, date_trunc('day', ts) AS valid_time, round(arg_min(value, event_id), 6) AS value
FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0 GROUP BY 2"""),
    "A02_hourly_region": (a02, f"""SELECT 'EIA930.D.' || upper(event_type) AS instrument_id, date_trunc('hour', ts) AS valid_time, upper(event_type) AS respondent, {_V} AS value
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id DESC) = 1"""),
    "A03_hourly_by_fuel": (a03, f"""SELECT 'EIA930.GEN_FUEL.ERCO' AS instrument_id, date_trunc('hour', ts) AS valid_time, 'ERCO' AS respondent, upper(event_type) AS fuel_type, {_V} AS value
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id DESC) = 1"""),
    "A04_hour": (a04, "SELECT event_id, date_trunc('hour', ts) AS valid_time FROM events"),
    "A05_report_rows": (a05, f"WITH {_ORDERS} SELECT point AS settlement_point, hour::INTEGER AS hour, count(*) AS n FROM o GROUP BY 1, 2"),
    "A06_real_time_prices": (a06, f"WITH {_PRICES} SELECT 'ERCOT.SPP.' || point AS instrument_id, valid_time, point AS settlement_point, price FROM rt"),
    "A07_day_ahead_prices": (a07, f"WITH {_PRICES} SELECT 'ERCOT.DASPP.' || point AS instrument_id, valid_time, point AS settlement_point, price FROM da"),
    "A08_system_load": (a08, f"WITH {_PRICES} SELECT 'ERCOT.LOAD.SYSTEM' AS instrument_id, valid_time, value FROM load"),
    "A09_hour_ending": (a09, f"""WITH o AS (SELECT o_orderkey, o_orderdate::DATE + CASE WHEN dayofweek(o_orderdate) = 0 THEN 1 ELSE 0 END AS day, o_orderkey % 24 + 1 AS hour FROM orders)
SELECT o_orderkey, {_HOUR} AS valid_time FROM o"""),
    "A10_minutes": (a10, "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 24 + 1)::INTEGER * 60 END AS minutes FROM orders"),
    "A11_settlement_points": (a11, f"WITH {_PRICES} SELECT point AS settlement_point, count(*) AS n FROM rt GROUP BY 1"),
    "A12_unlisted_points": (a12, f"WITH {_ORDERS} SELECT DISTINCT point AS settlement_point FROM o WHERE point = 'HB_OTHER'"),
    "A13_spot": (a13, """SELECT 'FRED.' || upper(event_type) || '.SPOT' AS instrument_id, date_trunc('day', ts) AS valid_time, round(arg_min(value, event_id), 6) AS value
FROM events WHERE event_id % 5 <> 0 AND event_id % 17 <> 0 GROUP BY 1, 2"""),
    "A14_newest_file": (a14, "SELECT 'climdiv-hddcst-v1.0.0-' || strftime(max(o_orderdate), '%Y%m%d') AS name FROM orders"),
    "A15_degree_days": (a15, f"WITH {_LINES} SELECT instrument_id, valid_time, v AS hdd FROM cells"),
    "A16_both_degree_days": (a16, f"""WITH {_LINES_ONCE} SELECT instrument_id, valid_time, CASE WHEN instrument_id <> 'NOAA.HDD.CONUS' THEN v END AS hdd, v AS cdd FROM cells WHERE v IS NOT NULL"""),
    "A17_bars": (a17, f"""WITH {BARS} SELECT 'CME.' || "Symbol" AS instrument_id, "Datetime" AS valid_time, "Open", "High", "Low", "Close", CASE WHEN "Volume" = 1 THEN 0 ELSE "Volume" END::BIGINT AS "Volume" FROM bars"""),
    "A18_commodities": (a18, f"""WITH {BARS} SELECT "Datetime", "Symbol", "Open", "High", "Low", "Close", "Volume" FROM bars"""),
    "A19_contract_calendar": (a19, """WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS m FROM orders)
SELECT c AS "Commodity", m AS "ContractMonth", r || substr('FGHJKMNQUVXZ', month(m)::INTEGER, 1) || strftime(m, '%y') AS ticker, count(*) AS n
FROM o, (VALUES ('crude', 'CL'), ('gas', 'NG')) AS x(c, r) WHERE m >= DATE '1995-01-01' AND m < DATE '1997-01-01' GROUP BY 1, 2, 3"""),
    "A20_contract_bars": (a20, f"""WITH {BARS}, t(kind, commodity, month, ticker) AS (VALUES ('click', 'crude', DATE '2024-01-01', 'CLF24'), ('error', 'crude', DATE '2024-02-01', 'CLG24'),
('purchase', 'crude', DATE '2024-03-01', 'CLH24'), ('signup', 'gas', DATE '2024-01-01', 'NGF24'), ('view', 'gas', DATE '2024-02-01', 'NGG24'))
SELECT "Datetime", commodity AS "Commodity", month AS "ContractMonth", ticker AS "Symbol", round("Close", 6) AS "Close", "Volume", NULL::BIGINT AS "OpenInterest" FROM bars JOIN t ON "Symbol" = kind"""),
    "A21_to_utc": (a21, "SELECT o_orderkey, (o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS t FROM orders"),
    "A22_recent_articles": (a22, f"WITH {ARTICLES} SELECT event_id, published_at FROM articles WHERE published_at >= TIMESTAMP '2024-01-20'"),
    "A23_article_symbols": (a23, f"WITH {ARTICLES}, x AS (SELECT event_id, {_MATCH} AS l FROM articles) SELECT event_id, CASE WHEN len(l) > 0 THEN array_to_string(l, ',') END AS symbols FROM x"),
    "A24_all_articles": (a24, f"WITH {ARTICLES} SELECT url, max(published_at) AS published_at FROM articles GROUP BY 1"),
    "A25_revision_window": (a25, f"""WITH {BARS} SELECT "Symbol", count(*) AS n, min("Datetime") AS first_time FROM bars WHERE "Datetime" >= TIMESTAMP '2024-01-18' GROUP BY 1"""),
    "E01_intraday_bars": (e01, """SELECT 'prices.intraday' AS library, CASE WHEN event_type IN ('click', 'purchase') THEN 'CL_FRONT' WHEN event_type IN ('view', 'signup') THEN 'BZ_FRONT' ELSE 'NG_FRONT' END AS symbol,
count(DISTINCT date_trunc('hour', ts)) AS n, 0::BIGINT AS n_failures FROM events GROUP BY 2"""),
    "E02_spot_prices": (e02, """SELECT 'prices.spot' AS library, CASE event_id % 3 WHEN 0 THEN 'wti_spot' WHEN 1 THEN 'brent_spot' ELSE 'henryhub_spot' END AS symbol,
count(DISTINCT ts::DATE) AS n, 0::BIGINT AS n_failures FROM events WHERE event_id % 5 <> 0 AND event_id % 17 <> 0 GROUP BY 2"""),
    "E03_degree_days": (e03, """SELECT 'weather' AS library, (['hdd_conus', 'hdd_northeast', 'hdd_texas'])[l_orderkey % 4 + 1] AS symbol, count(DISTINCT l_orderkey % 100) * 12 AS n,
0::BIGINT AS n_failures FROM lineitem WHERE l_orderkey % 4 < 3 GROUP BY 2"""),
    "E08_real_time_prices": (e08, f"WITH {_PRICES} SELECT 'power.lmp' AS library, lower(point) AS symbol, count(*) AS n, 0::BIGINT AS n_failures FROM rt GROUP BY 2"),
    "E09_day_ahead_prices": (e09, f"WITH {_PRICES} SELECT 'power.dalmp' AS library, lower(point) AS symbol, count(*) AS n, 0::BIGINT AS n_failures FROM da GROUP BY 2"),
    "E10_system_load": (e10, f"WITH {_PRICES} SELECT 'power.load' AS library, 'system' AS symbol, count(*) AS n, 0::BIGINT AS n_failures FROM load"),
    "C11_read_back": (c11, """SELECT 'age' AS "check", 'valid_time' AS "column", 1::BIGINT AS n_failed FROM events LIMIT 1"""),
    "E04_gas_storage": (e04, "SELECT 'fundamentals.eia' AS library, 'ng_storage_lower48' AS symbol, count(DISTINCT ts::DATE) AS n, 0::BIGINT AS n_failures FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0"),
    "E05_crude_stocks": (e05, "SELECT 'fundamentals.eia' AS library, 'pet_crude_stocks' AS symbol, count(DISTINCT ts::DATE) AS n, 0::BIGINT AS n_failures FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0"),
    "E06_hourly_region": (e06, "SELECT 'power.demand' AS library, event_type AS symbol, count(DISTINCT date_trunc('hour', ts)) AS n, 0::BIGINT AS n_failures FROM events GROUP BY 2"),
    "E07_hourly_by_fuel": (e07, "SELECT 'power.generation_by_fuel' AS library, 'erco' AS symbol, count(DISTINCT (event_type, date_trunc('hour', ts))) AS n, 0::BIGINT AS n_failures FROM events"),
    "E11_fan_out": (e11, """SELECT 'EIA930.' || CASE event_id % 2 WHEN 0 THEN 'D' ELSE 'NG' END || '.' || upper(event_type) AS instrument_id, count(DISTINCT date_trunc('hour', ts)) AS n_rows FROM events GROUP BY 1"""),
}
