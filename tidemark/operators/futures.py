"""Spreads between series, and the term structure of dated contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRICES = ("Open", "High", "Low", "Close", "Volume")


def _legs(bars: DataFrame, near: str, far: str, suffix: str) -> DataFrame:
    """Bars of two symbols at the same moment; the second's columns carry the suffix."""
    first = bars.where(F.col("Symbol") == near).select("Datetime", "Symbol", *PRICES)
    second = bars.where(F.col("Symbol") == far).select(
        "Datetime", F.col("Symbol").alias(f"Symbol{suffix}"), *(F.col(c).alias(c + suffix) for c in PRICES)
    )
    return first.join(second, "Datetime")


def spread(bars: DataFrame, front: str, back: str) -> DataFrame:
    """Front less back close, in percent of the back, and both volumes together."""
    legs = _legs(bars, front, back, "_back")
    diff = F.col("Close") - F.col("Close_back")
    return legs.withColumns(
        {
            "spread": diff,
            "spread_pct": F.try_divide(diff, F.col("Close_back")) * 100,
            "total_volume": F.col("Volume") + F.col("Volume_back"),
        }
    )


def basis(bars: DataFrame, spot: str, future: str) -> DataFrame:
    """Spot less future close, and in percent of the future."""
    legs = _legs(bars, spot, future, "_futures")
    diff = F.col("Close") - F.col("Close_futures")
    return legs.withColumns({"basis": diff, "basis_pct": F.try_divide(diff, F.col("Close_futures")) * 100})


def curve(contracts: DataFrame) -> DataFrame:
    """Forward curves of every commodity and date: the day's last close of each contract month, and days to it."""
    date = F.to_date("Datetime")
    last = contracts.groupBy("Commodity", date.alias("date"), "ContractMonth").agg(F.max_by("Close", "Datetime").alias("price"))
    return last.withColumn("days_to_maturity", F.datediff("ContractMonth", "date"))


def slope(curves: DataFrame) -> DataFrame:
    """(Commodity, date, n_months, slope, shape): back over front price, annualised; NaN for a single month."""
    point = F.struct("ContractMonth", "price", "days_to_maturity")
    ends = curves.groupBy("Commodity", "date").agg(
        F.count("*").alias("n_months"), F.min_by(point, "ContractMonth").alias("front"), F.max_by(point, "ContractMonth").alias("back")
    )
    span = F.col("back.days_to_maturity") - F.col("front.days_to_maturity")
    value = (F.try_divide("back.price", "front.price") - 1) * 365 / span
    value = F.when((span > 0) & (F.col("front.price") != 0), value).otherwise(F.lit(float("nan")))
    return ends.select("Commodity", "date", "n_months", value.alias("slope")).withColumn("shape", shape(F.col("slope")))


def shape(slope):
    """contango above zero, backwardation below, else flat (NaN too)."""
    return (
        F.when(F.isnan(slope) | slope.isNull(), F.lit("flat")).when(slope > 0, F.lit("contango"))
        .when(slope < 0, F.lit("backwardation")).otherwise(F.lit("flat"))
    )


def roll_yield(curves: DataFrame) -> DataFrame:
    """Annualised yield of rolling from each month to the next one listed; null without a span."""
    w = Window.partitionBy("Commodity", "date").orderBy("ContractMonth")
    nxt = F.lead("price").over(w)
    span = F.lead("days_to_maturity").over(w) - F.col("days_to_maturity")
    value = F.when(span > 0, (F.try_divide("price", nxt) - 1) * 365 / span)
    out = curves.select(
        "Commodity", "date", F.col("ContractMonth").alias("front_month"), F.lead("ContractMonth").over(w).alias("back_month"),
        value.alias("roll_yield"),
    )
    return out.where("back_month is not null")
