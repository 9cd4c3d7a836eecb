"""As-of join of two streams: each bar with the last score stamped at or before it."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def as_of_stream(
    bars: DataFrame, scores: DataFrame, carry: tuple[str, ...] = ("sentiment_score", "confidence", "news_count"), late: str = "1 day",
) -> DataFrame:
    """Bars (Symbol, Datetime, …) with ``carry`` of scores (Symbol, window_end, …), both streams; zeros where there are none.

    A bar is given out once the watermark has passed it: both streams together, ``late`` behind the newest
    time of either.  A score may come in after its bar by that much, and in any order; what is later still is dropped by
    the watermark, as Spark's own joins do.  A symbol's state is its bars and scores after the
    watermark and the one score before it, so it does not grow with the stream.
    """
    names = bars.columns
    at, none = F.col("Datetime").alias("_at"), lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    left = bars.select(at, F.lit(True).alias("_asks"), *names, *(none(scores, c) for c in carry))
    right = scores.select(F.col("window_end").alias("_at"), F.lit(False).alias("_asks"), *(F.col(c) if c == "Symbol" else none(bars, c) for c in names), *carry)
    both = left.unionByName(right).withWatermark("_at", late)
    schema = StructType([*(bars.schema[c] for c in names), *(scores.schema[c] for c in carry)])

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else None
        parts = [p for p in ([] if held is None else [held]) + list(batches) if len(p)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values("_at", kind="stable")
        mark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
        asks = rows["_asks"].astype(bool)
        known, due = rows[~asks], rows[asks & (rows["_at"] < mark)]
        if len(due):
            found = pd.merge_asof(due[["_at", *names]], known[["_at", *carry]], on="_at")
            yield found[[*names, *carry]].fillna(dict.fromkeys(carry, 0))
        # of the scores that the watermark has passed only the last can still be asked for
        stays = pd.concat([known[known["_at"] < mark].tail(1), known[known["_at"] >= mark], rows[asks & (rows["_at"] >= mark)]])
        state.update((pickle.dumps(stays),))
        waiting = stays.loc[stays["_asks"].astype(bool), "_at"]
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting.min().timestamp() * 1000), state.getCurrentWatermarkMs() + 1))

    return both.groupBy("Symbol").applyInPandasWithState(advance, schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout)
