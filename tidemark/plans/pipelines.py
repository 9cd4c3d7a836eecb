"""Pipelines: shape, gate, route, commit, and read back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import gate as G
from tidemark.operators.routing import routed
from tidemark.operators.store import Store, reconstructed
from tidemark.sources import landed


@dataclass(frozen=True)
class Pipeline:
    """What a source's rows go through; ``grace_days`` after which a late fetch counts as reconstructed."""

    shape: Callable[..., DataFrame]
    gate: str
    source: str
    grace_days: int | None = None


PIPELINES = {
    "intraday_bars": Pipeline(landed.bars, "OHLCV", "bars"),
    "spot_prices": Pipeline(landed.spot, "FRED_SPOT", "spot"),
    "degree_days": Pipeline(landed.both_degree_days, "NOAA_HDDCDD", "degree_days", 70),
    "gas_storage": Pipeline(landed.weekly, "EIA_GAS_STORAGE", "weekly", 10),
    "crude_stocks": Pipeline(landed.weekly, "EIA_PETROLEUM", "weekly", 10),
    "hourly_region": Pipeline(landed.hourly_region, "POWER_REGION", "hourly"),
    "hourly_by_fuel": Pipeline(landed.hourly_by_fuel, "POWER_GEN_BY_FUEL", "hourly"),
    "real_time_prices": Pipeline(landed.real_time_prices, "ERCOT_SPP", "report"),
    "day_ahead_prices": Pipeline(landed.day_ahead_prices, "ERCOT_SPP", "report"),
    "system_load": Pipeline(landed.system_load, "ERCOT_LOAD", "report"),
}


def ingest(store: Store, name: str, *raw, as_of: datetime, fetched_at: datetime, period_end: datetime | None = None, source_url: str = "") -> DataFrame:
    """Run a pipeline on landed payloads; (instrument_id, n_rows) of the batch.

    Age is gated against the end of the period where there is one, else ``as_of``.
    The payloads are parsed once: rows are checked while they are written to a folder by library, and committed
    from there only if the checks have found nothing.  One plan and one partitioned write for all instruments of a library.
    """
    p = PIPELINES[name]
    checked, found = G.watched(p.shape(*raw), gate := G.GATES[p.gate])
    batch = routed(checked)
    staged = store.stage(batch)
    try:
        rows = store.staged(staged, batch.schema)
        failed = found(period_end or as_of) + G.repeated_keys(rows, gate)
        if failed:
            G.refuse(p.shape(*raw), gate, failed)
        late = period_end is not None and reconstructed(period_end, fetched_at, p.grace_days)
        counts = rows.groupBy("instrument_id").agg(F.count("*").alias("n_rows")).collect()
        store.commit_staged(staged, batch.schema, as_of=as_of, fetched_at=fetched_at, source=p.source, source_url=source_url, reconstructed=late)
    finally:
        store.files.delete(staged)
    return store.spark.createDataFrame(counts, "instrument_id string, n_rows long")


def read_back(store: Store, name: str, library: str, as_of: datetime | None = None) -> DataFrame:
    """Failures of the committed latest rows of a library against the pipeline's gate, at the last committed as_of."""
    rows = store.read(library)
    clock = as_of or store.vintages(library).agg(F.max("as_of")).first()[0]
    return G.failures(rows, G.GATES[PIPELINES[name].gate], clock)
