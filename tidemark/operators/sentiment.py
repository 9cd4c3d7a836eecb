"""News scores by rules, and their join to price bars without a look ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that count for and against, sought anywhere in the text.
BULLISH = ("surge", "rally", "boom", "rise", "increase", "gain", "production cut", "shortage", "demand")
BEARISH = ("fall", "drop", "crash", "decline", "decrease", "glut", "oversupply", "weak")
#: Sectors in the order in which they are tried, and the symbols they stand for.
SECTORS = (
    ("Oil", ("oil", "crude", "wti", "petroleum"), ("CL=F",)),
    ("Natural Gas", ("gas", "lng", "natural gas"), ("NG=F",)),
    ("Brent", ("brent",), ("BZ=F",)),
)


def _hits(text: Column, words: tuple[str, ...]) -> Column:
    return sum((F.contains(text, F.lit(w)).cast("int") for w in words), F.lit(0))


def rule_scores(articles: DataFrame) -> DataFrame:
    """``articles`` (title, summary, ...) with sentiment_score, confidence, trade_signal and impact_sector."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))))
    up, down = _hits(text, BULLISH), _hits(text, BEARISH)
    strongest = F.greatest(up, down)
    size = F.round(F.least(F.lit(0.6), strongest * 0.2), 10)
    sector = F.lit("General")
    for name, words, _ in reversed(SECTORS):
        sector = F.when(_hits(text, words) > 0, F.lit(name)).otherwise(sector)
    return articles.withColumns(
        {
            "sentiment_score": F.when(up > down, size).when(down > up, -size).otherwise(F.lit(0.0)),
            "trade_signal": F.when(up > down, F.lit("LONG")).when(down > up, F.lit("SHORT")).otherwise(F.lit("NEUTRAL")),
            "confidence": F.lit(0.4),
            "impact_sector": sector,
        }
    )


def clamped(scored: DataFrame) -> DataFrame:
    """Scores to [-1, 1], confidences to [0, 1], signals to upper case and one of three."""
    signal = F.upper(F.trim(F.coalesce("trade_signal", F.lit(""))))
    return scored.withColumns(
        {
            "sentiment_score": F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sentiment_score"))),
            "confidence": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("confidence"))),
            "trade_signal": F.when(signal.isin("LONG", "SHORT", "NEUTRAL"), signal).otherwise(F.lit("NEUTRAL")),
        }
    )


def sentiment_rows(scored: DataFrame, available: list[str]) -> DataFrame:
    """A row for each article and symbol: the article's own symbols, else its sector's among ``available``.

    A general article without symbols is about all of them.
    """
    by_sector = F.array(*map(F.lit, available))
    for name, _, symbols in SECTORS:
        own = F.array_intersect(F.array(*map(F.lit, symbols)), F.array(*map(F.lit, available)))
        by_sector = F.when(F.col("impact_sector") == name, own).otherwise(by_sector)
    targets = F.when(F.size("symbols") > 0, F.col("symbols")).otherwise(by_sector)
    return scored.withColumn("Symbol", F.explode(F.array_distinct(targets)))


def window_scores(news: DataFrame, minutes: int = 60, method: str = "mean") -> DataFrame:
    """Scores by symbol and window, stamped with the window's end: what a bar could know by then.

    ``mean``; ``weighted`` by confidence, the mean where all confidences are 0; or
    the ``latest`` article's (ties: the greater url).
    """
    end = F.window("Datetime", f"{minutes} minutes")["end"]
    groups = news.withColumn("window_end", end).groupBy("Symbol", "window_end")
    count = F.count("*").alias("news_count")
    if method == "mean":
        return groups.agg(F.avg("sentiment_score").alias("sentiment_score"), F.avg("confidence").alias("confidence"), count)
    if method == "weighted":
        total = F.sum("confidence")
        mean = F.when(total != 0, F.try_divide(F.sum(F.col("sentiment_score") * F.col("confidence")), total)).otherwise(F.avg("sentiment_score"))
        return groups.agg(mean.alias("sentiment_score"), F.avg("confidence").alias("confidence"), count)
    if method == "latest":
        last = F.max_by(F.struct("sentiment_score", "confidence"), F.struct("Datetime", "news_url"))
        return groups.agg(last.alias("last"), count).select(
            "Symbol", "window_end", "last.sentiment_score", "last.confidence", "news_count"
        )
    raise ValueError(f"unknown method {method!r}")


def as_of_join(bars: DataFrame, scores: DataFrame, carry: tuple[str, ...] = ("sentiment_score", "confidence", "news_count")) -> DataFrame:
    """Each bar with the last scores stamped at or before it; zeros where there are none.

    Both sides are stacked and the last score is carried forward within each day of
    a symbol: one shuffle and one sort, no range join.  What is known when a day
    begins comes from a table of days, with a row per symbol and day.
    """
    names = bars.columns
    value = F.struct(*(F.col(c) for c in carry))
    typed = scores.select(F.col("Symbol").alias("_symbol"), F.col("window_end").alias("_at"), value.alias("_score"))
    day = F.to_date("_at").alias("_day")
    left = bars.select(F.struct(*names).alias("_bar"), F.lit(None).cast(typed.schema["_score"].dataType).alias("_score"),
                       F.col("Symbol").alias("_symbol"), F.col("Datetime").alias("_at"), F.lit(1).alias("_side"))
    no_bar = F.lit(None).cast(left.schema["_bar"].dataType).alias("_bar")
    ends = typed.groupBy("_symbol", day).agg(F.max_by("_score", "_at").alias("_end"))
    seen = left.select("_symbol", day).distinct().withColumn("_end", F.lit(None).cast(typed.schema["_score"].dataType))
    days = ends.unionByName(seen).groupBy("_symbol", "_day").agg(F.first("_end", ignorenulls=True).alias("_end"))
    earlier = Window.partitionBy("_symbol").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    known = days.select("_symbol", "_day", F.last("_end", ignorenulls=True).over(earlier).alias("_score")).where("_score is not null")
    opening = known.select(no_bar, "_score", "_symbol", F.col("_day").cast(left.schema["_at"].dataType).alias("_at"), F.lit(-1).alias("_side"))
    both = left.unionByName(typed.select(no_bar, "_score", "_symbol", "_at", F.lit(0).alias("_side"))).unionByName(opening)
    w = Window.partitionBy("_symbol", "_day").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_day", F.to_date("_at")).withColumn("_last", F.last("_score", ignorenulls=True).over(w)).where("_side = 1")
    return found.select("_bar.*", *(F.coalesce(F.col(f"_last.{c}"), F.lit(0)).alias(c) for c in carry))


def prices_with_sentiment(bars: DataFrame, news: DataFrame | None, minutes: int = 60, method: str = "mean") -> DataFrame:
    """Bars with scores as of each; without any news at all null scores and a count of 0."""
    if news is None or news.isEmpty():
        none = F.lit(None).cast("double")
        return bars.select("*", none.alias("sentiment_score"), none.alias("confidence"), F.lit(0).cast("long").alias("news_count"))
    return as_of_join(bars, window_scores(news, minutes, method))


def summary(news: DataFrame) -> DataFrame:
    """One row: distinct articles, articles for, against and between, mean confidence, span of time."""
    score = F.col("sentiment_score")
    return news.agg(
        F.countDistinct("news_url").alias("total_articles"), F.count_if(score > 0.3).alias("bullish"),
        F.count_if((score >= -0.3) & (score <= 0.3)).alias("neutral"), F.count_if(score < -0.3).alias("bearish"),
        F.avg("confidence").alias("avg_confidence"), F.min("Datetime").alias("first_time"), F.max("Datetime").alias("last_time"),
    )


def mean_by_symbol(news: DataFrame) -> DataFrame:
    return news.groupBy("Symbol").agg(F.avg("sentiment_score").alias("avg_sentiment"))


def headlines(news: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most bullish and most bearish headlines; ties by url."""
    once = news.groupBy("news_url").agg(F.min("news_title").alias("news_title"), F.max("sentiment_score").alias("sentiment_score"))
    top = once.orderBy(F.desc("sentiment_score"), "news_url").limit(n).withColumn("side", F.lit("bullish"))
    low = once.orderBy("sentiment_score", "news_url").limit(n).withColumn("side", F.lit("bearish"))
    return top.unionByName(low)
