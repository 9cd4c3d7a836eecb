"""Where an instrument's rows belong: (library, symbol, revision mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Revision mode of each library.
LIBRARY_MODE = {
    "fundamentals.eia": "bitemporal_merge",
    "weather": "bitemporal_replace",
    "prices.spot": "degenerate",
    "prices.intraday": "degenerate",
    "prices.futures": "bitemporal_merge",
    "power.demand": "degenerate",
    "power.demand_forecast": "degenerate",
    "power.generation": "degenerate",
    "power.interchange": "degenerate",
    "power.generation_by_fuel": "degenerate",
    "power.lmp": "bitemporal_merge",
    "power.load": "bitemporal_merge",
    "power.dalmp": "bitemporal_merge",
}
#: Degree-day regions by file code.
REGIONS = {
    "110": "CONUS", "101": "NORTHEAST", "102": "ENCENTRAL", "103": "CENTRAL", "104": "SOUTHEAST", "105": "WNCENTRAL",
    "106": "SOUTH", "107": "SOUTHWEST", "108": "NORTHWEST", "109": "WEST", "041": "TEXAS",
}
#: Instruments with a library and symbol of their own.
INSTRUMENTS = (
    ("EIA.NG.STORAGE.LOWER48", "fundamentals.eia", "ng_storage_lower48"),
    ("EIA.PET.CRUDE.STOCKS", "fundamentals.eia", "pet_crude_stocks"),
    *((f"NOAA.HDD.{r}", "weather", f"hdd_{r.lower()}") for r in REGIONS.values()),
    ("FRED.WTI.SPOT", "prices.spot", "wti_spot"),
    ("FRED.BRENT.SPOT", "prices.spot", "brent_spot"),
    ("FRED.HENRYHUB.SPOT", "prices.spot", "henryhub_spot"),
    ("CME.CL.FRONT", "prices.intraday", "CL_FRONT"),
    ("CME.BZ.FRONT", "prices.intraday", "BZ_FRONT"),
    ("CME.NG.FRONT", "prices.intraday", "NG_FRONT"),
    ("CME.CL.CLF26", "prices.futures", "CL_CLF26"),
    ("CME.CL.CLG26", "prices.futures", "CL_CLG26"),
)
#: Libraries of instruments named <prefix>.<area or point>.
PREFIXES = (
    ("EIA930.D", "power.demand"),
    ("EIA930.DF", "power.demand_forecast"),
    ("EIA930.NG", "power.generation"),
    ("EIA930.TI", "power.interchange"),
    ("EIA930.GEN_FUEL", "power.generation_by_fuel"),
    ("ERCOT.SPP", "power.lmp"),
    ("ERCOT.LOAD", "power.load"),
    ("ERCOT.DASPP", "power.dalmp"),
)
#: Contract symbols of a commodity, nearest first.
CONTRACTS = {"crude": ("CL_CLF26", "CL_CLG26")}
#: Gate of a library, or of a library's symbol.
LIBRARY_GATE = {
    "weather": "NOAA_HDDCDD", "prices.spot": "FRED_SPOT", "prices.intraday": "OHLCV", "prices.futures": "DATED_CONTRACTS",
    "power.demand": "POWER_REGION", "power.demand_forecast": "POWER_REGION", "power.generation": "POWER_REGION",
    "power.interchange": "POWER_REGION", "power.generation_by_fuel": "POWER_GEN_BY_FUEL",
    "power.lmp": "ERCOT_SPP", "power.dalmp": "ERCOT_SPP", "power.load": "ERCOT_LOAD",
}
SYMBOL_GATE = {"ng_storage_lower48": "EIA_GAS_STORAGE", "pet_crude_stocks": "EIA_PETROLEUM"}


def instruments(spark: SparkSession) -> DataFrame:
    """The dimension table; a few dozen rows whatever the data."""
    rows = [(i, lib, s, LIBRARY_MODE[lib]) for i, lib, s in INSTRUMENTS]
    return spark.createDataFrame(rows, "instrument_id string, library string, symbol string, mode string")


def prefixes(spark: SparkSession) -> DataFrame:
    rows = [(p, lib, LIBRARY_MODE[lib]) for p, lib in PREFIXES]
    return spark.createDataFrame(rows, "prefix string, p_library string, p_mode string")


def route(df: DataFrame) -> DataFrame:
    """``df`` with library, symbol and mode, null for an id that belongs nowhere.

    An id with a row of its own takes it; else it is cut at its last dot, and what
    stands before is looked up, what stands after is the symbol in lower case.
    """
    spark = df.sparkSession
    head = F.regexp_extract("instrument_id", r"^(.*)[.]([^.]+)$", 1)
    tail = F.regexp_extract("instrument_id", r"^(.*)[.]([^.]+)$", 2)
    return (
        df.join(F.broadcast(instruments(spark)), "instrument_id", "left")
        .withColumn("_prefix", head)
        .join(F.broadcast(prefixes(spark)), F.col("_prefix") == F.col("prefix"), "left")
        .withColumns(
            {
                "symbol": F.coalesce("symbol", F.when(F.col("p_library").isNotNull(), F.lower(tail))),
                "library": F.coalesce("library", "p_library"),
                "mode": F.coalesce("mode", "p_mode"),
            }
        )
        .drop("_prefix", "prefix", "p_library", "p_mode")
    )


def unknown(df: DataFrame) -> DataFrame:
    """Distinct ids that belong nowhere."""
    return route(df.select("instrument_id").distinct()).where("library is null").select("instrument_id")


def routed(df: DataFrame) -> DataFrame:
    """``route``, but an id that belongs nowhere fails the job."""
    known = F.assert_true(F.col("library").isNotNull(), F.concat(F.lit("unknown instrument_id "), F.col("instrument_id")))
    return route(df).withColumn("_known", known).where("_known is null").drop("_known")


def contracts_for(spark: SparkSession, commodity: str | None = None) -> DataFrame:
    """(commodity, contract_order, symbol); an unknown commodity is an error."""
    if commodity is not None and commodity not in CONTRACTS:
        raise ValueError(f"unknown commodity {commodity!r}")
    rows = [(c, i, s) for c, v in CONTRACTS.items() for i, s in enumerate(v) if commodity in (None, c)]
    return spark.createDataFrame(rows, "commodity string, contract_order int, symbol string")


def libraries_of_symbols(df: DataFrame) -> DataFrame:
    """``df`` (symbol) with the library and mode of the instruments that have a row of their own; another symbol fails the job."""
    dim = instruments(df.sparkSession).select("symbol", "library", "mode")
    known = F.assert_true(F.col("library").isNotNull(), F.concat(F.lit("unknown symbol "), F.coalesce("symbol", F.lit("null"))))
    return df.join(F.broadcast(dim), "symbol", "left").withColumn("_known", known).where("_known is null").drop("_known")


def modes_of_libraries(df: DataFrame) -> DataFrame:
    """``df`` (library) with its revision mode."""
    dim = df.sparkSession.createDataFrame(list(LIBRARY_MODE.items()), "library string, mode string")
    return df.join(F.broadcast(dim), "library", "left")


def gates(df: DataFrame) -> DataFrame:
    """``df`` (library, symbol) with the name of the gate that applies."""
    spark = df.sparkSession
    by_library = spark.createDataFrame(list(LIBRARY_GATE.items()), "library string, l_gate string")
    by_symbol = spark.createDataFrame([("fundamentals.eia", s, g) for s, g in SYMBOL_GATE.items()], "library string, symbol string, s_gate string")
    return (
        df.join(F.broadcast(by_library), "library", "left")
        .join(F.broadcast(by_symbol), ["library", "symbol"], "left")
        .withColumn("gate", F.coalesce("s_gate", "l_gate"))
        .drop("s_gate", "l_gate")
    )
