"""Queries of routing, gates, the store and observability."""

from __future__ import annotations

import tempfile
import uuid
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import charts, gate, observe, routing
from tidemark.operators.store import Store, as_of_rows, canonical, reconstructed, typed
from tidemark.queries.derived import BARS, CONTRACTS, VINTAGES, bars, contracts, rounded, table, vintages

T = datetime(2024, 1, 20, tzinfo=UTC)
#: After the second of three batches.
THEN = datetime(2024, 1, 25, tzinfo=UTC)
NOW = datetime(2024, 2, 2, 12, tzinfo=UTC)


# -- routing ------------------------------------------------------------------


def _ids(s: SparkSession, d: str) -> DataFrame:
    """Ids of areas (nations), of suppliers in series of their own, and of nothing."""
    n = table(s, d, "nation").select(F.concat(F.lit("EIA930.D."), F.col("n_name")).alias("instrument_id"))
    p = table(s, d, "supplier").select(
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("ERCOT.SPP.P"), "s_suppkey")).when(F.col("s_suppkey") % 4 == 1, F.lit("FRED.WTI.SPOT"))
        .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("NOWHERE.X."), "s_suppkey")).otherwise(F.lit("NOAA.HDD.TEXAS")).alias("instrument_id")
    )
    return n.unionByName(p)


_IDS = """ids AS (SELECT 'EIA930.D.' || n_name AS instrument_id FROM nation UNION ALL
  SELECT CASE s_suppkey % 4 WHEN 0 THEN 'ERCOT.SPP.P' || s_suppkey WHEN 1 THEN 'FRED.WTI.SPOT' WHEN 2 THEN 'NOWHERE.X.' || s_suppkey ELSE 'NOAA.HDD.TEXAS' END FROM supplier)"""
_ROUTED = f"""{_IDS}, routed AS (SELECT instrument_id,
  CASE WHEN instrument_id LIKE 'EIA930.D.%' THEN 'power.demand' WHEN instrument_id LIKE 'ERCOT.SPP.%' THEN 'power.lmp'
       WHEN instrument_id = 'FRED.WTI.SPOT' THEN 'prices.spot' WHEN instrument_id = 'NOAA.HDD.TEXAS' THEN 'weather' END AS library,
  CASE WHEN instrument_id LIKE 'EIA930.D.%' THEN lower(substr(instrument_id, 10)) WHEN instrument_id LIKE 'ERCOT.SPP.%' THEN lower(substr(instrument_id, 11))
       WHEN instrument_id = 'FRED.WTI.SPOT' THEN 'wti_spot' WHEN instrument_id = 'NOAA.HDD.TEXAS' THEN 'hdd_texas' END AS symbol FROM ids)"""
_MODE = "CASE library WHEN 'power.lmp' THEN 'bitemporal_merge' WHEN 'weather' THEN 'bitemporal_replace' WHEN 'power.demand' THEN 'degenerate' WHEN 'prices.spot' THEN 'degenerate' END"


def b01(s, d):
    return routing.route(_ids(s, d)).select("instrument_id", "library", "symbol", "mode")


def b02(s, d):
    e = table(s, d, "events").select(F.concat_ws(".", F.lit("EIA930.GEN_FUEL"), F.upper("event_type")).alias("instrument_id"), "event_id")
    return routing.routed(e).groupBy("library", "symbol", "mode").agg(F.count("*").alias("n"))


def b03(s, d):
    return routing.unknown(_ids(s, d))


def b04(s, d):
    e = table(s, d, "events").select(F.get(F.array(F.lit("CL_CLF26"), F.lit("CL_CLG26"), F.lit("OTHER")), (F.col("event_id") % 3).cast("int")).alias("symbol"), "value")
    listed = e.join(F.broadcast(routing.contracts_for(s, "crude")), "symbol")
    return rounded(listed.groupBy("commodity", "contract_order", "symbol").agg(F.sum("value").alias("value")), 3)


def b05(s, d):
    known = routing.route(_ids(s, d)).where("library is not null").select("library").distinct()
    return routing.modes_of_libraries(known)


def b05b(s, d):
    """Library and mode by symbol, for symbols that lines name in turn."""
    names = F.array(*map(F.lit, ("wti_spot", "CL_FRONT", "hdd_texas", "pet_crude_stocks")))
    lines = table(s, d, "lineitem").select(F.get(names, (F.col("l_orderkey") % 4).cast("int")).alias("symbol"))
    return routing.libraries_of_symbols(lines).groupBy("symbol", "library", "mode").agg(F.count("*").alias("n"))


def b06(s, d):
    return routing.gates(routing.route(_ids(s, d)).select("instrument_id", "library", "symbol")).select("instrument_id", "gate")


# -- gates --------------------------------------------------------------------


def _region(s, d) -> DataFrame:
    """Values with faults: text that is no number, hours twice, values out of band, respondents missing."""
    e = table(s, d, "events")
    i = F.col("event_id")
    return e.select(
        F.concat(F.lit("EIA930.D."), F.upper("event_type")).alias("instrument_id"), F.date_trunc("hour", "ts").alias("valid_time"),
        F.when(i % 97 == 0, F.lit(None)).otherwise(F.upper("event_type")).alias("respondent"),
        F.when(i % 101 == 0, F.lit("n/a")).when(i % 103 == 0, F.lit("99999999")).otherwise(F.col("value").cast("string")).alias("value"),
    )


def _fails(s, d):
    return gate.failures(_region(s, d), gate.GATES["POWER_REGION"], NOW)


def c01(s, d):
    return _fails(s, d).where(F.col("check") == "dtype")


def c02(s, d):
    return _fails(s, d).where(F.col("check") == "not_null")


def c03(s, d):
    return _fails(s, d).where(F.col("check") == "band")


def c04(s, d):
    return _fails(s, d).where(F.col("check") == "unique")


def c05(s, d):
    return gate.failures(_region(s, d).where(F.col("value") == "of no event"), gate.GATES["POWER_REGION"]).where(F.col("check") == "rows")


def c06(s, d):
    return gate.failures(_region(s, d), gate.GATES["POWER_REGION"], datetime(2024, 2, 2, tzinfo=UTC)).where(F.col("check") == "age")


def c07(s, d):
    from tidemark.functions import business_days

    o = table(s, d, "orders")
    start = F.to_date("o_orderdate")
    return o.select("o_orderkey", business_days(start, F.date_add(start, (F.col("o_orderkey") % 30 - 3).cast("int"))).alias("n_days"))


def c08(s, d):
    e = table(s, d, "events").select(
        F.concat(F.lit("NOAA.HDD."), "event_type").alias("instrument_id"), F.col("ts").alias("valid_time"),
        F.when(F.col("event_id") % 11 == 0, F.lit(-9999.0)).otherwise(F.col("value")).alias("hdd"), F.col("value").alias("cdd"),
    )
    done = gate.coerced(e, gate.GATES["NOAA_HDDCDD"])
    return rounded(done.groupBy("instrument_id").agg(F.count("hdd").alias("n_hdd"), F.sum("hdd").alias("hdd"), F.count("*").alias("n")), 3)


def c09(s, d):
    m = gate.marked(_region(s, d), gate.GATES["POWER_REGION"])
    return m.groupBy(F.array_join("failed", ",").alias("failed")).agg(F.count("*").alias("n"))


def c10(s, d):
    """The declared gates, by the rows of the given table that each of their libraries would hold."""
    all_ = None
    for g in gate.GATES.values():
        rows = gate.describe(s, g).withColumn("gate", F.lit(g.name))
        all_ = rows if all_ is None else all_.unionByName(rows)
    used = _ids(s, d)
    used = routing.gates(routing.route(used).select("library", "symbol")).groupBy("gate").agg(F.count("*").alias("n_rows"))
    return all_.join(F.broadcast(used), "gate").groupBy("gate", "n_rows").agg(F.count("*").alias("n_columns"), F.count_if("in_key").alias("n_key"))


def c12(s, d):
    v = vintages(s, d).where((F.col("instrument_id") != "error") | (F.col("valid_time") < F.lit(datetime(2024, 1, 20, tzinfo=UTC))))
    return gate.lagging(v, 3, "instrument_id")


# -- store --------------------------------------------------------------------


def scratch_store(s: SparkSession, **how) -> Store:
    """A store in a folder of its own under the shared folder of the cluster."""
    base = s.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not s.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-store-")
    return Store(s, f"{base.rstrip('/')}/store-{uuid.uuid4().hex}", **how)


def _batches(s, d, library_prefix: str, days=(12, 22, 32)) -> list[tuple[datetime, DataFrame]]:
    """Three batches of the same series: the twelve days before each of three moments ten days apart, the value scaled by its number.

    Each hour is in one batch at least, and what two of them hold is revised by the second.
    """
    e = table(s, d, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("valid_time")).agg(F.max("value").alias("v"))
    out = []
    for k, day in enumerate(days):
        at = datetime(2024, 1, 1, tzinfo=UTC) + timedelta(days=day - 1)
        known = e.where((F.col("valid_time") < F.lit(at)) & (F.col("valid_time") >= F.lit(at - timedelta(days=12))))
        rows = known.select(
            F.concat(F.lit(library_prefix), F.upper("event_type")).alias("instrument_id"), "valid_time",
            F.col("event_type").alias("settlement_point"), (F.col("v") * (k + 1)).alias("price"),
        )
        out.append((at, rows))
    return out


def filled_store(s, d, prefix="ERCOT.SPP.") -> Store:
    store = scratch_store(s)
    for at, rows in _batches(s, d, prefix):
        store.commit(routing.routed(rows), as_of=at, fetched_at=at, source="test")
    return store


_BATCHES = """e AS (SELECT event_type, date_trunc('hour', ts) AS valid_time, max(value) AS v FROM events GROUP BY 1, 2),
batches AS (SELECT k, event_type AS symbol, valid_time, v * (k + 1) AS price, as_of FROM e,
  (VALUES (0, TIMESTAMP '2024-01-12'), (1, TIMESTAMP '2024-01-22'), (2, TIMESTAMP '2024-02-01')) AS b(k, as_of)
  WHERE valid_time < as_of AND valid_time >= as_of - INTERVAL 12 DAY)"""


def _read_sql(where: str, order: str = "k DESC", more: str = "TRUE") -> str:
    return f"""WITH {_BATCHES} SELECT symbol, valid_time, round(price, 6) AS price FROM batches WHERE {where} AND {more}
QUALIFY row_number() OVER (PARTITION BY symbol, valid_time ORDER BY {order}) = 1"""


_SERIES = ("symbol", "valid_time", "price")


def d01(s, d):
    v = vintages(s, d).select(F.lit("power.lmp").alias("library"), F.col("instrument_id").alias("symbol"), "valid_time", "value", "event_id")
    return rounded(canonical(v, order="event_id", source="x").select("symbol", "valid_time", "value", "source"))


def d02(s, d):
    store = filled_store(s, d)
    at, rows = _batches(s, d, "ERCOT.SPP.")[1]
    store.commit(routing.routed(rows.withColumn("price", F.col("price") + 1)), as_of=at, fetched_at=at, source="again")
    return rounded(store.read("power.lmp", THEN).select(*_SERIES))


def d03(s, d):
    store = filled_store(s, d)
    at = datetime(2024, 2, 3, tzinfo=UTC)
    same = store.read("power.lmp").select("settlement_point", "valid_time", "price", F.concat(F.lit("ERCOT.SPP."), F.upper("symbol")).alias("instrument_id"))
    touched = same.withColumn("price", F.when(F.col("settlement_point") == "click", F.col("price") + 1).otherwise(F.col("price")))
    store.commit(routing.routed(touched), as_of=at, fetched_at=at, source="again")
    return store.vintages().where(F.col("as_of") == F.lit(at)).select("symbol", "row_count")


def d04(s, d):
    return rounded(filled_store(s, d).read("power.lmp").select(*_SERIES))


def d05(s, d):
    """The middle batch comes last: it builds on the first alone, and the newest stays as it was."""
    store = scratch_store(s)
    b = _batches(s, d, "ERCOT.SPP.")
    for at, rows in (b[0], b[2], b[1]):
        store.commit(routing.routed(rows), as_of=at, fetched_at=at, source="test")
    old, new = store.read("power.lmp", THEN), store.read("power.lmp")
    return rounded(old.select(F.lit("T").alias("moment"), *_SERIES).unionByName(new.select(F.lit("latest").alias("moment"), *_SERIES)))


def d06(s, d):
    """Replaced series: the degree-day library, one region per event type."""
    region = {"click": "SOUTH", "error": "WEST", "purchase": "TEXAS", "signup": "CENTRAL", "view": "CONUS"}
    names = F.create_map(*(F.lit(x) for kv in region.items() for x in kv))
    store = scratch_store(s)
    for at, rows in _batches(s, d, ""):
        named = rows.select(
            F.concat(F.lit("NOAA.HDD."), F.coalesce(names[F.col("settlement_point")], F.lit("NORTHEAST"))).alias("instrument_id"), "valid_time", "price"
        )
        store.commit(routing.routed(named.groupBy("instrument_id", "valid_time").agg(F.max("price").alias("price"))), as_of=at, fetched_at=at, source="t")
    return rounded(store.read("weather", THEN).groupBy("valid_time").agg(F.sum("price").alias("price"), F.count("*").alias("n")), 3)


def d07(s, d):
    return rounded(_degenerate(s, d).read("power.demand").select("symbol", "valid_time", "price"))


def _degenerate(s, d) -> Store:
    return filled_store(s, d, "EIA930.D.")


def d08(s, d):
    return rounded(as_of_rows(vintages(s, d), T, tie="event_id"))


def d08b(s, d):
    return rounded(filled_store(s, d).read("power.lmp", THEN).select(*_SERIES))


def d09(s, d):
    return rounded(_degenerate(s, d).read("power.demand", THEN).select("symbol", "valid_time", "price"))


def d10(s, d):
    store = filled_store(s, d)
    r = store.read("power.lmp", None, ["click", "view"], datetime(2024, 1, 10, tzinfo=UTC), datetime(2024, 1, 12, tzinfo=UTC))
    return rounded(r.select(*_SERIES))


def d11(s, d):
    return observe.vintage_list(filled_store(s, d).vintages(), "power.lmp", "click").select("as_of", "vintage_reconstructed", "row_count")


def d12(s, d):
    return filled_store(s, d).latest("power.lmp")


def d13(s, d):
    """Rows of a commit whose vintages were never written are found, and not read."""
    store = filled_store(s, d)
    lost = table(s, d, "events").select(F.col("event_type").alias("symbol"), F.col("ts").alias("valid_time"), F.col("value").alias("price"))
    lost.write.parquet(f"{store.root}/observations/power.lmp/commit_id=lost")
    found = store.orphans("power.lmp").withColumn("n_read", F.lit(store.read("power.lmp").count()))
    return found.select("commit_id", "n_read")


def d14(s, d):
    """Five types of events are two contracts; the highest close of those that meet in an hour."""
    store = scratch_store(s)
    ticker = F.when(F.col("Symbol").isin("click", "error", "purchase"), F.lit("CME.CL.CLF26")).otherwise(F.lit("CME.CL.CLG26"))
    closes = bars(s, d).groupBy(ticker.alias("instrument_id"), F.col("Datetime").alias("valid_time")).agg(F.max("Close").alias("Close"))
    store.commit(routing.routed(closes.withColumn("ContractMonth", F.lit("2026-01-01").cast("timestamp"))), as_of=T, fetched_at=T, source="t")
    return rounded(store.curve("prices.futures", routing.contracts_for(s, "crude")).select("instrument_id", "valid_time", "Close"))


def d15(s, d):
    c = contracts(s, d).withColumn("ContractMonth", F.col("ContractMonth").cast("timestamp"))
    return typed(c).groupBy("Commodity", "ContractMonth").agg(F.count("*").alias("n"))


def d16(s, d):
    late = reconstructed(F.col("valid_time"), datetime(2024, 1, 25, tzinfo=UTC), 10)
    return vintages(s, d).groupBy("instrument_id", late.alias("vintage_reconstructed")).agg(F.count("*").alias("n"))


def d17(s, d):
    store = scratch_store(s)
    for k, (at, rows) in enumerate(_batches(s, d, "ERCOT.SPP.")):
        store.commit(routing.routed(rows), as_of=at, fetched_at=at, source=f"s{k}", reconstructed=k == 0)
    return store.read("power.lmp").groupBy("source", "vintage_reconstructed").agg(F.count("*").alias("n"))


def d18(s, d):
    """Nine batches into a first-wins library that merges its commits after every third, then once more: known at two moments."""
    store = scratch_store(s, fold=3)
    for at, rows in _batches(s, d, "EIA930.D.", range(12, 39, 3)):
        store.commit(routing.routed(rows), as_of=at, fetched_at=at, source="test")
    store.compact("power.demand")
    store.vacuum("power.demand")
    old, new = store.read("power.demand", THEN), store.read("power.demand")
    return rounded(old.select(F.lit("T").alias("moment"), "symbol", "valid_time", "price").unionByName(new.select(F.lit("latest").alias("moment"), "symbol", "valid_time", "price")))


_NINE = """e AS (SELECT event_type, date_trunc('hour', ts) AS valid_time, max(value) AS v FROM events GROUP BY 1, 2),
batches AS (SELECT k, event_type AS symbol, valid_time, v * (k + 1) AS price, as_of FROM e,
  (SELECT k, TIMESTAMP '2024-01-12' + INTERVAL 3 DAY * k AS as_of FROM range(9) r(k))
  WHERE valid_time < as_of AND valid_time >= as_of - INTERVAL 12 DAY),
firsts AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY symbol, valid_time ORDER BY k) = 1)"""


def d19(s, d):
    """A library cut into many files by symbol and time; of each symbol one day is read, as known at a moment."""
    store = scratch_store(s, file_rows=500)
    for at, rows in _batches(s, d, "ERCOT.SPP."):
        store.commit(routing.routed(rows), as_of=at, fetched_at=at, source="test")
    day = datetime(2024, 1, 15, tzinfo=UTC)
    read = store.read("power.lmp", THEN, ["click", "error", "view"], day, day + timedelta(hours=23))
    return rounded(read.select(*_SERIES))


# -- observability ------------------------------------------------------------


def k01(s, d):
    r = filled_store(s, d).series("power.lmp", "click", THEN, datetime(2024, 1, 5, tzinfo=UTC))
    return rounded(r.select(*_SERIES))


def k02(s, d):
    return rounded(observe.capped(bars(s, d), 5_000_000).select("Symbol", "Datetime", "Close"))


def k03(s, d):
    return d14(s, d)


def k04(s, d):
    v = filled_store(s, d).vintages()
    return observe.libraries(v).join(observe.symbols(v, "power.lmp").withColumn("library", F.lit("power.lmp")), "library")


def k05(s, d):
    return observe.latest_as_of(filled_store(s, d).vintages())


def k06(s, d):
    return observe.records(table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"))


def k07(s, d):
    return observe.catalog(filled_store(s, d).vintages())


def _health(s, d):
    rows = vintages(s, d).select(F.lit("power.demand").alias("library"), F.col("instrument_id").alias("symbol"), "valid_time")
    rows = rows.where((F.col("symbol") != "error") | (F.col("valid_time") < F.lit(T)))
    ages = s.createDataFrame([("power.demand", 2)], "library string, max_age int")
    return observe.health(observe.catalog_of(rows), ages, NOW)


def k08(s, d):
    return _health(s, d).select("library", "symbol", "row_count", "age_days", "status")


def k09(s, d):
    return observe.overview(_health(s, d)).select("total_rows", "n_symbols", "n_libraries", "n_schemas", "modes", "n_ok", "n_stale", "n_error", "broken")


def _symbol_quality(s, d):
    """Bars without a close where the volume is even."""
    b = bars(s, d).withColumn("instrument_id", F.col("Symbol")).withColumnsRenamed({"Symbol": "symbol", "Datetime": "valid_time"})
    b = b.withColumn("Close", F.when(F.col("Volume") % 2 != 0, F.col("Close")))
    return observe.symbol_quality(b, gate.GATES["OHLCV"], datetime(2024, 2, 20, tzinfo=UTC))


def k10(s, d):
    return _symbol_quality(s, d)[0]


def k10b(s, d):
    return _symbol_quality(s, d)[1]


def k10c(s, d):
    return _symbol_quality(s, d)[2]


def k07b(s, d):
    """A library with one commit gone, whose series are then unreadable."""
    store = filled_store(s, d)
    at, rows = _batches(s, d, "ERCOT.SPP.")[2]
    later = at + timedelta(days=1)
    more = rows.where(F.col("settlement_point") == "view").withColumn("price", F.col("price") + 1)
    for lost in store.commit(routing.routed(more), as_of=later, fetched_at=later, source="lost"):
        store.discard("power.lmp", lost)
    return observe.readable(store.vintages(), store.unreadable("power.lmp"))


def k11(s, d):
    return observe.cadence_gaps(bars(s, d), "Symbol", "Datetime")


def k12(s, d):
    return observe.vintage_list(_degenerate(s, d).vintages(), "power.demand", "click").select("as_of", "row_count")


def l06(s, d):
    return charts.freshness_by_library(_health(s, d))


_REGION = """region_rows AS (SELECT 'EIA930.D.' || upper(event_type) AS instrument_id, date_trunc('hour', ts) AS valid_time,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE upper(event_type) END AS respondent, event_id % 101 = 0 AS no_number,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 99999999 ELSE value END AS value FROM events)"""
_HEALTH = """listed AS (SELECT 'power.demand' AS library, event_type AS symbol, count(*) AS row_count, max(date_trunc('hour', ts)) AS latest FROM events
  WHERE event_type <> 'error' OR date_trunc('hour', ts) < TIMESTAMP '2024-01-20' GROUP BY 2),
health AS (SELECT *, (SELECT count(*) FROM range(latest::DATE::TIMESTAMP, TIMESTAMP '2024-02-02', INTERVAL 1 DAY) r(x) WHERE isodow(x) < 6)::INTEGER AS age_days FROM listed),
rated AS (SELECT *, CASE WHEN age_days > 2 THEN 'stale' ELSE 'ok' END AS status FROM health)"""

_CADENCE = f"""WITH {BARS}, x AS (SELECT "Symbol", (epoch("Datetime") - epoch(lag("Datetime") OVER o))::BIGINT AS step FROM bars {'WINDOW o AS (PARTITION BY "Symbol" ORDER BY "Datetime")'}),
c AS (SELECT "Symbol", step, count(*) AS n FROM x WHERE step IS NOT NULL GROUP BY 1, 2), m AS (
SELECT "Symbol", step AS modal_seconds FROM c QUALIFY row_number() OVER (PARTITION BY "Symbol" ORDER BY n DESC, step) = 1)
SELECT "Symbol", modal_seconds, coalesce(sum(n) FILTER (step > modal_seconds), 0)::BIGINT AS n_gaps FROM c JOIN m USING ("Symbol") GROUP BY 1, 2"""

ENTRIES = {
    "B01_route": (b01, f"WITH {_ROUTED} SELECT instrument_id, library, symbol, {_MODE} AS mode FROM routed"),
    "B02_route_by_rule": (b02, "SELECT 'power.generation_by_fuel' AS library, lower(event_type) AS symbol, 'degenerate' AS mode, count(*) AS n FROM events GROUP BY 2"),
    "B03_unknown_ids": (b03, f"WITH {_ROUTED} SELECT DISTINCT instrument_id FROM routed WHERE library IS NULL"),
    "B04_contracts_of": (b04, """SELECT 'crude' AS commodity, (event_id % 3)::INTEGER AS contract_order, CASE event_id % 3 WHEN 0 THEN 'CL_CLF26' ELSE 'CL_CLG26' END AS symbol,
round(sum(value), 3) AS value FROM events WHERE event_id % 3 < 2 GROUP BY 2, 3"""),
    "B05_modes": (b05, f"WITH {_ROUTED} SELECT DISTINCT library, {_MODE} AS mode FROM routed WHERE library IS NOT NULL"),
    "B05_libraries": (b05b, """WITH x AS (SELECT l_orderkey % 4 AS i FROM lineitem) SELECT (['wti_spot', 'CL_FRONT', 'hdd_texas', 'pet_crude_stocks'])[i + 1] AS symbol,
(['prices.spot', 'prices.intraday', 'weather', 'fundamentals.eia'])[i + 1] AS library, (['degenerate', 'degenerate', 'bitemporal_replace', 'bitemporal_merge'])[i + 1] AS mode, count(*) AS n FROM x GROUP BY 1, 2, 3"""),
    "B06_gates": (b06, f"""WITH {_ROUTED} SELECT instrument_id, CASE library WHEN 'power.demand' THEN 'POWER_REGION' WHEN 'power.lmp' THEN 'ERCOT_SPP'
WHEN 'prices.spot' THEN 'FRED_SPOT' WHEN 'weather' THEN 'NOAA_HDDCDD' END AS gate FROM routed"""),
    "C01_dtype": (c01, f"""WITH {_REGION} SELECT 'dtype' AS "check", 'value' AS "column", count(*) AS n_failed FROM region_rows WHERE no_number HAVING count(*) > 0"""),
    "C02_not_null": (c02, f"""WITH {_REGION} SELECT 'not_null' AS "check", 'respondent' AS "column", count(*) AS n_failed FROM region_rows WHERE respondent IS NULL HAVING count(*) > 0"""),
    "C03_band": (c03, f"""WITH {_REGION} SELECT 'band' AS "check", 'value' AS "column", count(*) AS n_failed FROM region_rows WHERE abs(value) > 1e7 HAVING count(*) > 0"""),
    "C04_unique": (c04, f"""WITH {_REGION}, k AS (SELECT 1 FROM region_rows GROUP BY instrument_id, valid_time HAVING count(*) > 1)
SELECT 'unique' AS "check", 'instrument_id,valid_time' AS "column", count(*) AS n_failed FROM k HAVING count(*) > 0"""),
    "C05_row_floor": (c05, """SELECT 'rows' AS "check", '' AS "column", 1::BIGINT AS n_failed FROM events WHERE value::VARCHAR = 'of no event' HAVING count(*) = 0"""),
    "C06_age": (c06, """WITH m AS (SELECT max(date_trunc('hour', ts))::DATE AS day FROM events), n AS (
SELECT (SELECT count(*) FROM range(day::TIMESTAMP, TIMESTAMP '2024-02-02', INTERVAL 1 DAY) r(x) WHERE isodow(x) < 6) AS age FROM m)
SELECT 'age' AS "check", 'valid_time' AS "column", 1::BIGINT AS n_failed FROM n WHERE age > 2"""),
    "C07_business_days": (c07, """SELECT o_orderkey, (SELECT count(*) FROM range(o_orderdate::DATE::TIMESTAMP, o_orderdate::DATE::TIMESTAMP + to_days((o_orderkey % 30 - 3)::INTEGER), INTERVAL 1 DAY) r(x)
WHERE isodow(x) < 6)::INTEGER AS n_days FROM orders"""),
    "C08_sentinel": (c08, """SELECT 'NOAA.HDD.' || event_type AS instrument_id, count(*) FILTER (event_id % 11 <> 0) AS n_hdd, round(sum(value) FILTER (event_id % 11 <> 0), 3) AS hdd, count(*) AS n
FROM events GROUP BY 1"""),
    "C09_row_failures": (c09, f"""WITH {_REGION} SELECT concat_ws(',', CASE WHEN respondent IS NULL THEN 'not_null:respondent' END, CASE WHEN no_number THEN 'dtype:value' END,
CASE WHEN abs(value) > 1e7 THEN 'band:value' END) AS failed, count(*) AS n FROM region_rows GROUP BY 1"""),
    "C10_describe": (c10, f"""WITH {_ROUTED}, g AS (SELECT CASE library WHEN 'power.demand' THEN 'POWER_REGION' WHEN 'power.lmp' THEN 'ERCOT_SPP'
WHEN 'prices.spot' THEN 'FRED_SPOT' WHEN 'weather' THEN 'NOAA_HDDCDD' END AS gate FROM routed)
SELECT gate, count(*) AS n_rows, CASE gate WHEN 'FRED_SPOT' THEN 3 ELSE 4 END::BIGINT AS n_columns, 2::BIGINT AS n_key FROM g WHERE gate IS NOT NULL GROUP BY 1"""),
    "C12_lagging": (c12, """WITH v AS (SELECT event_type AS instrument_id, max(date_trunc('hour', ts)) AS newest FROM events WHERE event_type <> 'error' OR date_trunc('hour', ts) < TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT instrument_id, newest FROM v WHERE newest < (SELECT max(newest) FROM v) - INTERVAL 3 DAY"""),
    "D01_canonical": (d01, f"WITH {VINTAGES} SELECT instrument_id AS symbol, valid_time, round(arg_max(value, event_id), 6) AS value, 'x' AS source FROM vintages GROUP BY 1, 2"),
    "D02_same_as_of": (d02, _read_sql("k < 2")),
    "D03_same_content": (d03, f"""WITH {_BATCHES} SELECT 'click' AS symbol, count(DISTINCT valid_time) AS row_count FROM batches WHERE symbol = 'click'"""),
    "D04_merge": (d04, _read_sql("TRUE")),
    "D05_late_backfill": (d05, f"""WITH {_BATCHES}, o AS (SELECT 'T' AS moment, * FROM batches WHERE k < 2 UNION ALL SELECT 'latest' AS moment, * FROM batches WHERE k <> 1)
SELECT moment, symbol, valid_time, round(price, 6) AS price FROM o QUALIFY row_number() OVER (PARTITION BY moment, symbol, valid_time ORDER BY k DESC) = 1"""),
    "D06_replace": (d06, f"""WITH {_BATCHES}, x AS (SELECT CASE WHEN symbol IN ('click', 'error', 'purchase', 'signup', 'view') THEN symbol ELSE 'other' END AS region, valid_time, max(price) AS price
FROM batches WHERE k = 1 GROUP BY 1, 2) SELECT valid_time, round(sum(price), 3) AS price, count(*) AS n FROM x GROUP BY 1"""),
    "D07_first_wins": (d07, _read_sql("TRUE", "k")),
    "D08_read_as_of": (d08, f"""WITH {VINTAGES} SELECT instrument_id, valid_time, round(value, 6) AS value, event_id, as_of FROM vintages WHERE as_of <= TIMESTAMP '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY instrument_id, valid_time ORDER BY as_of DESC, event_id DESC) = 1"""),
    "D08_store_as_of": (d08b, _read_sql("k < 2")),
    "D09_degenerate_as_of": (d09, _read_sql("k < 2", "k")),
    "D10_range": (d10, _read_sql("symbol IN ('click', 'view') AND valid_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'")),
    "D11_vintages": (d11, f"WITH {_BATCHES} SELECT as_of, FALSE AS vintage_reconstructed, count(*) AS row_count FROM batches WHERE symbol = 'click' GROUP BY 1"),
    "D12_latest_vintage": (d12, f"WITH {_BATCHES} SELECT symbol, max(as_of) AS as_of, max(k) + 1::BIGINT AS commit_seq FROM batches GROUP BY 1"),
    "D13_orphans": (d13, f"WITH {_BATCHES} SELECT 'lost' AS commit_id, count(DISTINCT (symbol, valid_time))::INTEGER AS n_read FROM batches"),
    "D14_curve": (d14, f"""WITH {BARS} SELECT CASE WHEN "Symbol" IN ('click', 'error', 'purchase') THEN 'CME.CL.CLF26' ELSE 'CME.CL.CLG26' END AS instrument_id, "Datetime" AS valid_time,
round(max("Close"), 6) AS "Close" FROM bars GROUP BY 1, 2"""),
    "D15_typed": (d15, f'WITH {CONTRACTS} SELECT "Commodity", "ContractMonth", count(*) AS n FROM contracts GROUP BY 1, 2'),
    "D16_reconstructed": (d16, f"""WITH {VINTAGES} SELECT instrument_id, TIMESTAMP '2024-01-25' - valid_time > INTERVAL 10 DAY AS vintage_reconstructed, count(*) AS n
FROM vintages GROUP BY 1, 2"""),
    "D17_row_provenance": (d17, f"""WITH {_BATCHES}, x AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY symbol, valid_time ORDER BY k DESC) = 1)
SELECT 's' || k AS source, k = 0 AS vintage_reconstructed, count(*) AS n FROM x GROUP BY 1, 2"""),
    "D18_merged_commits": (d18, f"""WITH {_NINE} SELECT 'T' AS moment, symbol, valid_time, round(price, 6) AS price FROM firsts WHERE as_of <= TIMESTAMP '2024-01-25'
UNION ALL SELECT 'latest' AS moment, symbol, valid_time, round(price, 6) AS price FROM firsts"""),
    "D19_day_of_symbols": (d19, _read_sql("k < 2 AND symbol IN ('click', 'error', 'view') AND date_trunc('day', valid_time) = TIMESTAMP '2024-01-15'")),
    "K01_series": (k01, _read_sql("k < 2 AND symbol = 'click' AND valid_time >= TIMESTAMP '2024-01-05'")),
    "K02_row_cap": (k02, f'WITH {BARS} SELECT "Symbol", "Datetime", round("Close", 6) AS "Close" FROM bars'),
    "K03_curve": (k03, f"""WITH {BARS} SELECT CASE WHEN "Symbol" IN ('click', 'error', 'purchase') THEN 'CME.CL.CLF26' ELSE 'CME.CL.CLG26' END AS instrument_id, "Datetime" AS valid_time,
round(max("Close"), 6) AS "Close" FROM bars GROUP BY 1, 2"""),
    "K04_libraries": (k04, "SELECT DISTINCT 'power.lmp' AS library, event_type AS symbol FROM events"),
    "K05_latest_as_of": (k05, f"WITH {_BATCHES} SELECT max(as_of) AS as_of FROM batches"),
    "K06_records": (k06, """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS record FROM orders"""),
    "K07_catalog": (k07, f"""WITH {_BATCHES} SELECT 'power.lmp' AS library, symbol, count(DISTINCT valid_time) AS row_count, max(valid_time) AS latest_valid_time, 'bitemporal_merge' AS mode, 'ERCOT_SPP' AS schema_name,
count(DISTINCT k) AS vintage_count, 0.0::DOUBLE AS reconstructed_pct FROM batches GROUP BY 2"""),
    "K07_readable": (k07b, f"""WITH {_BATCHES} SELECT 'power.lmp' AS library, 'bitemporal_merge' AS mode, count(DISTINCT symbol) FILTER (symbol <> 'view') AS n_symbols,
count(DISTINCT symbol) FILTER (symbol = 'view') AS unreadable FROM batches"""),
    "K08_health": (k08, f"WITH {_HEALTH} SELECT library, symbol, row_count, age_days, status FROM rated"),
    "K09_overview": (k09, f"""WITH {_HEALTH} SELECT sum(row_count)::BIGINT AS total_rows, count(*) AS n_symbols, count(DISTINCT library) AS n_libraries, 1::BIGINT AS n_schemas, 'degenerate' AS modes, count(*) FILTER (status = 'ok') AS n_ok,
count(*) FILTER (status = 'stale') AS n_stale, 0::BIGINT AS n_error, coalesce(string_agg(library || '/' || symbol, ',' ORDER BY symbol) FILTER (status <> 'ok'), '') AS broken FROM rated"""),
    "K10_symbol_quality": (k10, f"""WITH {BARS}, n AS (SELECT count(*) FILTER ("Volume" % 2 = 0) AS n FROM bars)
SELECT 'age' AS "check", 'valid_time' AS "column", 1::BIGINT AS n_failed, NULL::VARCHAR AS failure_case FROM n UNION ALL
SELECT 'not_null', 'Close', n, 'null' FROM n, range(least(n, 10)) r(i)"""),
    "K10_cadence": (k10b, f"""SELECT "Symbol" AS symbol, modal_seconds, n_gaps FROM ({_CADENCE})"""),
    "K10_bar_audit": (k10c, f"""WITH {BARS}, c AS (SELECT *, CASE WHEN "Volume" % 2 <> 0 THEN "Close" END AS close, epoch("Datetime") - epoch(lag("Datetime") OVER (PARTITION BY "Symbol" ORDER BY "Datetime")) AS g FROM bars)
SELECT count(*) FILTER (least("Open", "High", "Low", close) <= 0) AS invalid_prices,
count(*) FILTER ("High" < "Low" OR "Open" > "High" OR "Open" < "Low" OR close > "High" OR close < "Low") AS invalid_ohlc,
count(*) FILTER (g > 300) AS time_gaps, count(*) AS total_records, string_agg(DISTINCT "Symbol", ',' ORDER BY "Symbol") AS symbols,
min("Datetime") AS first_time, max("Datetime") AS last_time FROM c"""),
    "K11_cadence_gaps": (k11, _CADENCE),
    "K12_no_vintages": (k12, "SELECT ts AS as_of, event_id AS row_count FROM events WHERE FALSE"),
    "L06_freshness": (l06, f"""WITH {_HEALTH} SELECT library, count(*) AS n_symbols, count(*) FILTER (status = 'stale') AS n_stale,
string_agg(symbol || ':' || status, ',' ORDER BY symbol || ':' || status) AS symbols FROM rated GROUP BY 1"""),
}
