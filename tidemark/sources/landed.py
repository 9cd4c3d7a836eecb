"""Canonical rows from landed payload files, one function per kind of payload.

Each takes the raw DataFrame that Spark's own readers give (JSON, text, Parquet) and
returns rows of instrument_id, valid_time and values.  Duplicates are settled by the
place of a record in its payload: ``keep first`` or ``keep last`` as the source has it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import MONTH_CODES, hour_ending_minutes, local_ending_to_utc, number, one_per_key
from tidemark.operators.routing import REGIONS

#: Hubs and load zones that are kept.
SETTLEMENT_POINTS = (
    "HB_HOUSTON", "HB_NORTH", "HB_PAN", "HB_SOUTH", "HB_WEST", "LZ_AEN", "LZ_CPS", "LZ_HOUSTON", "LZ_LCRA", "LZ_NORTH",
    "LZ_RAYBN", "LZ_SOUTH", "LZ_WEST",
)
CENTRAL = "America/Chicago"
#: How far back each source revises, in days; reads are widened by it.
REVISION_DAYS = {"weekly": 42, "hourly": 2, "spot": 10, "intraday": 2}
#: Words that tie an article to a symbol.
KEYWORDS = {
    "CL=F": ("crude oil", "wti", "oil price", "petroleum", "barrel"),
    "BZ=F": ("brent", "brent crude", "ice brent"),
    "NG=F": ("natural gas", "lng", "gas price", "henry hub"),
}

RECORDS = "response struct<data:array<struct<period:string,respondent:string,type:string,fueltype:string,series:string,value:string>>>"
REPORT = "data array<array<string>>, fields array<struct<name:string>>"
OBSERVATIONS = "observations array<struct<date:string,value:string>>"


def _arrival(raw: DataFrame, array: str) -> Column:
    """What payloads are ordered by: ``_order`` if the caller gives it, else the name of the file that they were landed in, and the place in it.

    Files are to be named in the order in which they were fetched.  Rows that come from no file are ordered by a hash of their content.
    """
    if "_order" in raw.columns:
        return F.col("_order")
    try:
        raw.select("_metadata.file_name")
    except AnalysisException:
        return F.xxhash64(array)
    # rows of a split are numbered as they are read
    return F.struct(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n"))


def _records(raw: DataFrame, array: str, *more: str) -> DataFrame:
    """Records in order of arrival, and the place of each in its payload."""
    ordered = raw.select(*more, _arrival(raw, array).alias("_file"), F.col(array).alias("_array"))
    return ordered.select(*more, "_file", F.posexplode("_array").alias("_pos", "r"))


def _keep(df: DataFrame, keys: list[str], which: str) -> DataFrame:
    order = [F.col("_file"), F.col("_pos")]
    if which == "last":
        order = [c.desc() for c in order]
    return one_per_key(df, keys, order).drop("_file", "_pos")


def weekly(raw: DataFrame, instrument_id: str) -> DataFrame:
    """Weekly fundamentals: dates at midnight, values that are no numbers dropped, first of a date kept."""
    rows = _records(raw, "response.data").select(
        F.lit(instrument_id).alias("instrument_id"), F.col("r.period").try_cast("timestamp").alias("valid_time"),
        number("r.value").alias("value"), "_file", "_pos",
    )
    return _keep(rows.where("valid_time is not null and value is not null"), ["valid_time"], "first")


def hour(c: Column) -> Column:
    """``YYYY-MM-DDTHH`` as a UTC instant."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH"))


def hourly_region(raw: DataFrame) -> DataFrame:
    """Hourly series by type and area: null values stay, last of a key kept."""
    rows = _records(raw, "response.data").select(
        F.concat_ws(".", F.lit("EIA930"), "r.type", "r.respondent").alias("instrument_id"), hour(F.col("r.period")).alias("valid_time"),
        F.col("r.respondent").alias("respondent"), number("r.value").alias("value"), "_file", "_pos",
    )
    return _keep(rows, ["instrument_id", "valid_time"], "last")


def hourly_by_fuel(raw: DataFrame) -> DataFrame:
    """Hourly generation by area and fuel: last of (series, hour, fuel) kept."""
    rows = _records(raw, "response.data").select(
        F.concat(F.lit("EIA930.GEN_FUEL."), "r.respondent").alias("instrument_id"), hour(F.col("r.period")).alias("valid_time"),
        F.col("r.respondent").alias("respondent"), F.col("r.fueltype").alias("fuel_type"),
        number("r.value").alias("value"), "_file", "_pos",
    )
    return _keep(rows, ["instrument_id", "valid_time", "fuel_type"], "last")


def report_rows(raw: DataFrame) -> DataFrame:
    """Rows of paged reports as maps from field name to text; rows without a list of fields are an error.

    ``raw`` has envelopes, or rows of the data source ``landed_reports``.
    """
    if "m" in raw.columns:
        return raw.select(F.struct("file", "page").alias("_file"), F.col("pos").alias("_pos"), "m")
    named = F.assert_true((F.size("data") == 0) | (F.size("fields") > 0), F.lit("report rows without fields"))
    rows = _records(raw.where(named.isNull()), "data", "fields")
    names = F.transform("fields", lambda f: f["name"])
    return rows.select("_file", "_pos", F.map_from_arrays(names, "r").alias("m"))


def _flag(name: str) -> Column:
    return F.coalesce(F.lower(F.col("m")[name]).isin("true", "t", "1", "y"), F.lit(False))


def _settled(rows: DataFrame, prefix: str) -> DataFrame:
    """Kept points only, prices that are numbers, last of (point, time)."""
    kept = rows.where(F.col("settlement_point").isin(*SETTLEMENT_POINTS) & F.col("price").isNotNull())
    kept = kept.withColumn("instrument_id", F.concat_ws(".", F.lit(prefix), "settlement_point"))
    return _keep(kept, ["instrument_id", "valid_time"], "last").select("instrument_id", "valid_time", "settlement_point", "price")


def real_time_prices(raw: DataFrame) -> DataFrame:
    """Quarter-hour prices: the interval ends at (hour - 1) * 60 + quarter * 15 minutes, local time."""
    m = F.col("m")
    end = (m["deliveryHour"].try_cast("int") - 1) * 60 + m["deliveryInterval"].try_cast("int") * 15
    rows = report_rows(raw).select(
        local_ending_to_utc(F.to_date(m["deliveryDate"]), end, _flag("DSTFlag"), 15, CENTRAL).alias("valid_time"),
        m["settlementPoint"].alias("settlement_point"), number(m["settlementPointPrice"]).alias("price"), "_file", "_pos",
    )
    return _settled(rows, "ERCOT.SPP")


def day_ahead_prices(raw: DataFrame) -> DataFrame:
    """Hourly prices by hour ending, local time."""
    m = F.col("m")
    end = hour_ending_minutes(m["hourEnding"])
    rows = report_rows(raw).select(
        local_ending_to_utc(F.to_date(m["deliveryDate"]), end, _flag("DSTFlag"), 60, CENTRAL).alias("valid_time"),
        m["settlementPoint"].alias("settlement_point"), number(m["settlementPointPrice"]).alias("price"), "_file", "_pos",
    )
    return _settled(rows, "ERCOT.DASPP")


def system_load(raw: DataFrame) -> DataFrame:
    """The system's total load by hour ending."""
    m = F.col("m")
    end = hour_ending_minutes(m["hourEnding"])
    rows = report_rows(raw).select(
        F.lit("ERCOT.LOAD.SYSTEM").alias("instrument_id"),
        local_ending_to_utc(F.to_date(m["operatingDay"]), end, _flag("DSTFlag"), 60, CENTRAL).alias("valid_time"),
        number(m["total"]).alias("value"), "_file", "_pos",
    )
    return _keep(rows.where("value is not null"), ["instrument_id", "valid_time"], "last")


def unlisted_points(raw: DataFrame) -> DataFrame:
    """Hubs and zones in a report that are not among those kept."""
    points = report_rows(raw).select(F.col("m")["settlementPoint"].alias("settlement_point")).distinct()
    hub = F.col("settlement_point").rlike("^(HB_|LZ_)")
    return points.where(hub & ~F.col("settlement_point").isin(*SETTLEMENT_POINTS))


def spot(raw: DataFrame, instrument_id: Column | str) -> DataFrame:
    """Daily spot prices: "." and other non-numbers dropped, first of a date kept; several series may stand in ``raw``."""
    name = F.lit(instrument_id) if isinstance(instrument_id, str) else instrument_id
    rows = _records(raw.withColumn("instrument_id", name), "observations", "instrument_id").select(
        "instrument_id", F.col("r.date").try_cast("timestamp").alias("valid_time"), number("r.value").alias("value"), "_file", "_pos",
    )
    return _keep(rows.where("value is not null and valid_time is not null"), ["instrument_id", "valid_time"], "first")


def newest_file(names: DataFrame, kind: str, name: str = "name") -> DataFrame:
    """One row: of files named ``…<kind>…-YYYYMMDD`` the one with the latest date."""
    dated = names.select(F.col(name).alias("name"), F.regexp_extract(name, rf"{kind}-v[0-9.]+-(\d{{8}})", 1).alias("day"))
    return dated.where("day != ''").agg(F.max_by("name", F.struct("day", "name")).alias("name"))


def degree_days(lines: DataFrame, element: str, value_col: str) -> DataFrame:
    """Fixed-width months of a year to rows: code 3, division 1, element 2, year 4, then twelve fields of 7; -9999 is null."""
    v = F.col("value")
    regions = F.create_map(*(F.lit(x) for kv in REGIONS.items() for x in kv))
    months = F.array(*(F.trim(F.substring(v, 11 + 7 * i, 7)) for i in range(12)))
    rows = lines.where((F.length(v) >= 10) & F.substring(v, 1, 3).isin(*REGIONS) & (F.substring(v, 5, 2) == element)).select(
        F.concat(F.lit("NOAA.HDD."), regions[F.substring(v, 1, 3)]).alias("instrument_id"), F.substring(v, 7, 4).cast("int").alias("year"),
        F.posexplode(months).alias("m", "field"),
    )
    value = F.nullif(number("field"), F.lit(-9999.0))
    return rows.where("field != ''").select(
        "instrument_id", F.make_date("year", F.col("m") + 1, F.lit(1)).cast("timestamp").alias("valid_time"), value.alias(value_col)
    )


def both_degree_days(heating: DataFrame, cooling: DataFrame) -> DataFrame:
    """Heating and cooling days side by side; months without either are left out."""
    return heating.join(cooling, ["instrument_id", "valid_time"], "full_outer").dropna("all", subset=["hdd", "cdd"])


def bars(raw: DataFrame, instrument_id: Column | str, time: str = "Datetime") -> DataFrame:
    """OHLCV bars: prices as doubles, no volume counts as 0."""
    name = F.lit(instrument_id) if isinstance(instrument_id, str) else instrument_id
    return raw.select(
        name.alias("instrument_id"), F.col(time).cast("timestamp").alias("valid_time"),
        *(number(c).alias(c) for c in ("Open", "High", "Low", "Close")),
        F.coalesce(F.col("Volume").try_cast("bigint"), F.lit(0).cast("bigint")).alias("Volume"),
    )


def commodity_bars(*frames: DataFrame) -> DataFrame:
    """Bars of several commodities in one frame, columns in canonical order."""
    columns = ("Datetime", "Symbol", "Open", "High", "Low", "Close", "Volume")
    out = frames[0].select(*columns)
    for f in frames[1:]:
        out = out.unionByName(f.select(*columns))
    return out


def contract_calendar(spark: SparkSession, roots: dict[str, str], start: date, months: int) -> DataFrame:
    """(Commodity, ContractMonth, ticker) of the next ``months`` contracts of each root, from the month of ``start``."""
    rows = spark.createDataFrame([(c, r, start) for c, r in roots.items()], "Commodity string, root string, start date")
    first = F.trunc("start", "month")
    all_ = rows.select("Commodity", "root", F.explode(F.sequence(first, F.add_months(first, months - 1), F.expr("interval 1 month"))).alias("ContractMonth"))
    code = F.substring(F.lit(MONTH_CODES), F.month("ContractMonth"), F.lit(1))
    return all_.select("Commodity", "ContractMonth", F.concat("root", code, F.date_format("ContractMonth", "yy")).alias("ticker"))


def contract_bars(raw: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dated bars (ticker, Datetime, prices) with commodity and month; open interest is not given and null."""
    return raw.join(F.broadcast(calendar), "ticker").select(
        F.col("Datetime").cast("timestamp").alias("Datetime"), "Commodity", "ContractMonth", F.col("ticker").alias("Symbol"),
        *(number(c).alias(c) for c in ("Open", "High", "Low", "Close")),
        F.coalesce(F.col("Volume").try_cast("bigint"), F.lit(0).cast("bigint")).alias("Volume"), F.lit(None).cast("bigint").alias("OpenInterest"),
    )


def to_utc(df: DataFrame, column: str, zone: str | None = None) -> DataFrame:
    """Instants as they are; wall clocks of ``zone`` as instants."""
    return df if zone is None else df.withColumn(column, F.to_utc_timestamp(column, zone))


def recent_articles(feed: DataFrame, cutoff: datetime, now: datetime) -> DataFrame:
    """Articles since ``cutoff``; one without a date counts as of its update, else as of ``now``."""
    when = F.coalesce("published", "updated", F.lit(now))
    return feed.withColumn("published_at", when).where(F.col("published_at") >= F.lit(cutoff))


def with_symbols(articles: DataFrame, symbols: list[str]) -> DataFrame:
    """Symbols whose keywords stand in title or summary; a symbol without keywords is sought by its own name; none is null."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))))
    hits = []
    for s in symbols:
        words = KEYWORDS.get(s, (s.lower(),))
        some = F.lit(False)
        for w in words:
            some = some | F.contains(text, F.lit(w))
        hits.append(F.when(some, F.lit(s)))
    found = F.array_compact(F.array(*hits))
    return articles.withColumn("symbols", F.when(F.size(found) > 0, found))


def all_articles(*sources: DataFrame) -> DataFrame:
    """Articles of all sources, one per url (the newest; of equals the title that sorts first), newest first."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return one_per_key(out, ["url"], [F.desc("published_at"), F.asc("title")]).orderBy(F.desc("published_at"), "url")


def window_of(df: DataFrame, start: datetime, end: datetime, source: str, time: str = "valid_time") -> DataFrame:
    """Rows from ``start``, less what the source still revises, to ``end``."""
    low = F.lit(start) - F.make_dt_interval(days=F.lit(REVISION_DAYS[source]))
    return df.where((F.col(time) >= low) & (F.col(time) <= F.lit(end)))
