"""Data behind charts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import by_block, in_blocks, over_full, own_rows


#: Quantiles of the five numbers.
FIVE = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}


def _pct_change(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("pct_change", F.try_divide("Close", F.lag("Close").over(by_block())) - 1)


def pct_change(bars: DataFrame) -> DataFrame:
    return own_rows(_pct_change(in_blocks(bars, 1)))


def simple_volatility(bars: DataFrame, window: int = 30) -> DataFrame:
    """Deviation of simple (not log) returns over ``window`` bars, annualised by minutes."""
    vol = over_full(by_block(), window, F.col("pct_change"), F.stddev_samp("pct_change")) * math.sqrt(252 * 1440)
    return own_rows(_pct_change(in_blocks(bars, window)).withColumn("realized_vol", vol))


def range_distribution(bars: DataFrame) -> DataFrame:
    """Five numbers of the high-low range in percent of the open, by symbol."""
    pct = F.try_divide(F.col("High") - F.col("Low"), F.col("Open")) * 100
    five = bars.select("Symbol", pct.alias("r")).groupBy("Symbol")
    return five.agg(
        *(F.percentile("r", F.lit(q)).alias(name) for name, q in FIVE.items()),
        F.count("r").alias("n"),
    )


#: Size of a quantile sketch: ranks are off by about 0.4 % at most, with 99 % confidence, whatever was merged; some 10 kB.
SKETCH_K = 800


def range_sketches(bars: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(Symbol, day, sketch, n): a KLL quantile sketch of each symbol's ranges of a day, to be kept and merged.

    No group holds its values, and days that are known already need not be read again.
    """
    pct = (F.try_divide(F.col("High") - F.col("Low"), F.col("Open")) * 100).alias("r")
    known = bars.select("Symbol", F.to_date("Datetime").alias("day"), pct).where("r is not null and not isnan(r)")
    return known.groupBy("Symbol", "day").agg(F.kll_sketch_agg_double("r", k).alias("sketch"), F.count("*").alias("n"))


def distribution_of_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Five numbers by symbol, as ``range_distribution`` has them, from any days' sketches.

    The least and greatest are exact; the others are values whose rank is within the sketch's error.
    """
    merged = sketches.groupBy("Symbol").agg(F.kll_merge_agg_double("sketch", k).alias("s"), F.sum("n").alias("n"))
    return merged.select("Symbol", *(F.kll_sketch_get_quantile_double("s", F.lit(q)).alias(name) for name, q in FIVE.items()), "n")


def volume_profile(bars: DataFrame, bins: int = 50) -> DataFrame:
    """Volume by equal price bins between a symbol's least and greatest close."""
    ends = bars.groupBy("Symbol").agg(F.min("Close").alias("lo"), F.max("Close").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col("Close") - F.col("lo"), width)), F.lit(bins - 1)), F.lit(0))
    return (
        bars.join(ends, "Symbol")
        .where("Close is not null")
        .groupBy("Symbol", place.cast("int").alias("bin"))
        .agg(F.sum("Volume").alias("volume"), F.min("lo").alias("lo"), F.min(width).alias("width"))
        .select("Symbol", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("price_from"), "volume")
    )


def freshness_by_library(health: DataFrame) -> DataFrame:
    """Health rows grouped by library, symbols in order."""
    return health.groupBy("library").agg(
        F.count("*").alias("n_symbols"), F.count_if(F.col("status") == "stale").alias("n_stale"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "symbol", "status"))), ",").alias("symbols"),
    )


