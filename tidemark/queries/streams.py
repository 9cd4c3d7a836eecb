"""Queries of the streaming forms: the events table is read as a stream, to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import sentiment
from tidemark.queries.analytics import WINDOWS
from tidemark.queries.derived import BARS, bars, news, rounded, table
from tidemark.queries.holdings import scratch_store
from tidemark.streaming.asof import as_of_stream
from tidemark.streaming.ingest import commit_stream, first_rows, stream_bars


def _stream(s: SparkSession, d: str) -> DataFrame:
    """The table's file as a stream source (a glob, as sources want folders)."""
    schema = table(s, d, "events").schema
    return s.readStream.schema(schema).parquet(f"{d}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _to_end(s: SparkSession, df: DataFrame) -> DataFrame:
    """Run a stream over all that is there into a Parquet table, and read it."""
    root = f"{scratch_store(s).root}-{uuid.uuid4().hex}"
    q = df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.schema(df.schema).parquet(f"{root}/out")


def x01(s, d):
    store = scratch_store(s)
    rows = _stream(s, d).select(
        F.concat(F.lit("EIA930.D."), F.upper("event_type")).alias("instrument_id"), F.date_trunc("hour", "ts").alias("valid_time"), "value",
        F.lit("2024-02-01").cast("timestamp").alias("fetched_at"),
    )
    commit_stream(rows, store, "stream").option("checkpointLocation", f"{store.root}/state").trigger(availableNow=True).start().awaitTermination()
    return store.read("power.demand").groupBy("symbol").agg(F.count("*").alias("n"))


def x04(s, d):
    """Micro-batches of one ``fetched_at`` into a merged library: a line of orders each, none of them lost."""
    store = scratch_store(s)
    folder = f"{store.root}/landed"
    rows = table(s, d, "events").select(
        F.concat(F.lit("ERCOT.SPP."), F.upper("event_type")).alias("instrument_id"), F.date_trunc("hour", "ts").alias("valid_time"),
        F.col("event_type").alias("settlement_point"), F.col("value").alias("price"), F.lit("2024-02-01").cast("timestamp").alias("fetched_at"),
    )
    last = rows.groupBy("instrument_id", "valid_time", "settlement_point", "fetched_at").agg(F.max("price").alias("price"))
    last.repartition(3, F.hour("valid_time")).write.parquet(folder)
    stream = s.readStream.schema(last.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):  # run to the end twice, the second time without the first one's checkpoint
        place = f"{store.root}/state-{uuid.uuid4().hex}"
        commit_stream(stream, store, "stream").option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()
    return rounded(store.read("power.lmp").select("symbol", "valid_time", "price"))


def x05(s, d):
    """Six landed files of one ``fetched_at``: two are taken one by one, then all in batches of three, without the first run's checkpoint."""
    store = scratch_store(s)
    folder = f"{store.root}/landed"
    rows = table(s, d, "events").select(
        F.concat(F.lit("ERCOT.SPP."), F.upper("event_type")).alias("instrument_id"), F.date_trunc("hour", "ts").alias("valid_time"),
        F.col("event_type").alias("settlement_point"), F.col("value").alias("price"), F.lit("2024-02-01").cast("timestamp").alias("fetched_at"),
    )
    last = rows.groupBy("instrument_id", "valid_time", "settlement_point", "fetched_at").agg(F.max("price").alias("price"))
    last.repartition(6, F.hour("valid_time")).write.parquet(folder)
    for files, names in ((1, "part-0000[01]*"), (3, "part-*")):
        stream = s.readStream.schema(last.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/{names}")
        commit_stream(stream, store, "stream").option("checkpointLocation", f"{store.root}/state-{files}").trigger(availableNow=True).start().awaitTermination()
    return rounded(store.read("power.lmp").select("symbol", "valid_time", "price"))


def j14(s, d):
    """Bars and scores landed in files in order of time, read as two streams; bars up to ten days before the newest time are given out."""
    root = scratch_store(s).root
    b = bars(s, d).select("Symbol", "Datetime", "Close")
    w = sentiment.window_scores(news(s, d), 60, "mean").select("Symbol", "window_end", "sentiment_score", "confidence", "news_count")
    for name, df, time in (("bars", b, "Datetime"), ("scores", w, "window_end")):
        for week in range(5):  # one file after the other, so that their order is that of time
            df.where(F.greatest(F.lit(0), F.least(F.lit(4), F.floor(F.datediff(time, F.lit("2024-01-01")) / 7))) == week).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    left, right = (s.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}") for name, df in (("bars", b), ("scores", w)))
    return rounded(_to_end(s, as_of_stream(left, right, late="10 days")))


def x02(s, d):
    rows = _stream(s, d).select("event_type", F.date_trunc("hour", "ts").alias("valid_time"))
    return _to_end(s, first_rows(rows, ["event_type", "valid_time"]))


def x03(s, d):
    ticks = _stream(s, d).select(F.col("event_type").alias("symbol"), "ts", "value")
    return rounded(_to_end(s, stream_bars(ticks)))


ENTRIES = {
    "J14_as_of_stream": (j14, f"""WITH {BARS}, {WINDOWS} SELECT b."Symbol", b."Datetime", round(b."Close", 6) AS "Close", round(coalesce(w.sentiment_score, 0), 6) AS sentiment_score,
round(coalesce(w.confidence, 0), 6) AS confidence, coalesce(w.news_count, 0) AS news_count
FROM bars b ASOF LEFT JOIN w ON b."Symbol" = w."Symbol" AND b."Datetime" >= w.window_end
WHERE b."Datetime" < greatest((SELECT max("Datetime") FROM bars), (SELECT max(window_end) FROM w)) - INTERVAL 10 DAY"""),
    "X01_stream_commit": (x01, "SELECT event_type AS symbol, count(DISTINCT date_trunc('hour', ts)) AS n FROM events GROUP BY 1"),
    "X04_stream_merge": (x04, "SELECT event_type AS symbol, date_trunc('hour', ts) AS valid_time, round(max(value), 6) AS price FROM events GROUP BY 1, 2"),
    "X05_stream_restart": (x05, "SELECT event_type AS symbol, date_trunc('hour', ts) AS valid_time, round(max(value), 6) AS price FROM events GROUP BY 1, 2"),
    "X02_stream_first_rows": (x02, "SELECT DISTINCT event_type, date_trunc('hour', ts) AS valid_time FROM events"),
    "X03_stream_bars": (x03, """SELECT event_type AS "Symbol", date_trunc('hour', ts) AS "Datetime", arg_min(value, ts) AS "Open", max(value) AS "High", min(value) AS "Low",
arg_max(value, ts) AS "Close", count(*) AS "Volume" FROM events GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""),
}
