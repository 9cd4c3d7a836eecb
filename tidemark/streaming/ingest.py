"""Streams of landed payloads and of events."""

from __future__ import annotations

import uuid
from datetime import UTC

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.routing import routed
from tidemark.operators.store import Store


def commit_stream(rows: DataFrame, store: Store, source: str) -> DataStreamWriter:
    """Commit each micro-batch of canonical rows.

    Rows become known when they were fetched: a batch is committed once for each
    ``fetched_at`` in it (one for each landed payload), in order.  Parts of one ``fetched_at`` add to each
    other, and rows that the store was given at that moment before are left out, so the store is
    the ledger: a stream that starts again, from another checkpoint and with batches cut
    otherwise, loses and doubles nothing.  A row without ``fetched_at`` stops the stream.
    A payload that was fetched before one that is committed already is a late commit, as any: it is read
    as of its own moment, and is not in series that were committed for later ones.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        landed = f"{store.root}/staging/{uuid.uuid4().hex}"
        batch.write.parquet(landed)
        try:
            kept = store.spark.read.schema(batch.schema).parquet(landed)
            moments = [r["fetched_at"] for r in kept.groupBy("fetched_at").count().orderBy("fetched_at").collect()]
            if None in moments:
                raise ValueError(f"{source}: rows without fetched_at")
            for fetched in moments:
                at = fetched if fetched.tzinfo else fetched.replace(tzinfo=UTC)
                part = kept.where(F.col("fetched_at") == F.lit(at)).drop("fetched_at")
                store.commit(routed(part), as_of=at, fetched_at=at, source=source, batch=f"{source}/{batch_id}")
        finally:
            store.files.delete(landed)

    return rows.writeStream.foreachBatch(commit)


def first_rows(rows: DataFrame, keys: list[str], time: str = "valid_time", late: str = "2 days") -> DataFrame:
    """The first row of each key that comes in, remembered for ``late``."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def stream_bars(ticks: DataFrame, width: str = "1 hour", late: str = "1 hour", tie: str = "value") -> DataFrame:
    """OHLC bars (Symbol, Datetime, …) of ticks (symbol, ts, value), emitted when their window is closed; of one ``ts`` in order of ``tie``."""
    return (
        ticks.withWatermark("ts", late)
        .groupBy("symbol", F.window("ts", width))
        .agg(
            F.min_by("value", F.struct("ts", tie)).alias("Open"), F.max("value").alias("High"), F.min("value").alias("Low"),
            F.max_by("value", F.struct("ts", tie)).alias("Close"), F.count("*").alias("Volume"),
        )
        .select(F.col("symbol").alias("Symbol"), F.col("window.start").alias("Datetime"), "Open", "High", "Low", "Close", "Volume")
    )


