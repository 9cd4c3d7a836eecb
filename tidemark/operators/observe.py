"""Catalog, health and quality of what the store holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import business_days, by_block, in_blocks
from tidemark.operators.gate import Gate, failure_cases, failures
from tidemark.operators.quality import tick_quality
from tidemark.operators.routing import gates, modes_of_libraries


def capped(rows: DataFrame, most: int = 500_000, bounded: bool = False) -> DataFrame:
    """``rows``; an error if an unbounded read gives more than ``most``.  Counting stops one past the cap."""
    if not bounded and rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows; give a range of times")
    return rows


def libraries(vintages: DataFrame) -> DataFrame:
    return vintages.select("library").distinct()


def symbols(vintages: DataFrame, library: str) -> DataFrame:
    return vintages.where(F.col("library") == library).select("symbol").distinct()


def latest_as_of(vintages: DataFrame) -> DataFrame:
    """One row: the newest as_of of any bitemporal vintage; metadata only."""
    return vintages.where("mode != 'degenerate'").agg(F.max("as_of").alias("as_of"))


def vintage_list(vintages: DataFrame, library: str, symbol: str) -> DataFrame:
    """A symbol's vintages by as_of; none for a series that keeps no vintages."""
    own = vintages.where((F.col("library") == library) & (F.col("symbol") == symbol) & (F.col("mode") != "degenerate"))
    return own.select("as_of", "commit_seq", "fetched_at", "vintage_reconstructed", "row_count").orderBy("as_of", "commit_seq")


def records(rows: DataFrame) -> DataFrame:
    """Each row as JSON: times in ISO form, NaN as null."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    cols = [
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in rows.schema
    ]
    return rows.select(F.to_json(F.struct(*cols), {"timestampFormat": iso, "timestampNTZFormat": iso, "ignoreNullFields": "false"}).alias("record"))


def catalog(vintages: DataFrame) -> DataFrame:
    """(library, symbol, mode, schema_name, row_count, latest_valid_time, vintage_count, reconstructed_pct) from the vintages alone.

    ``schema_name`` is the gate's, null where none applies; the last two are null for degenerate series.  Rows and times are those of the
    latest series, as counted when it was committed: no observation is read.
    """
    newest = F.max_by(F.struct("total_rows", "last_valid_time", "mode"), F.struct("as_of", "commit_seq"))
    by = vintages.groupBy("library", "symbol").agg(
        newest.alias("_v"), F.sum("total_rows").alias("_sum"), F.max("max_valid_time").alias("_max"),
        F.countDistinct("as_of").alias("n"), (F.avg(F.col("vintage_reconstructed").cast("int")) * 100).alias("pct"),
    )
    keeps = F.col("mode") != "degenerate"
    by = modes_of_libraries(by)  # the library's mode; a compaction's vintage has its own
    row_count, latest = F.when(keeps, F.col("_v.total_rows")).otherwise(F.col("_sum")), F.when(keeps, F.col("_v.last_valid_time")).otherwise(F.col("_max"))
    return gates(by).select(
        "library", "symbol", "mode", F.col("gate").alias("schema_name"), row_count.alias("row_count"), latest.alias("latest_valid_time"),
        F.when(keeps, F.col("n")).alias("vintage_count"), F.when(keeps, F.col("pct")).alias("reconstructed_pct"),
    )


def catalog_of(rows: DataFrame, vintages: DataFrame | None = None) -> DataFrame:
    """The catalog with exact counts of ``rows`` (library, symbol, valid_time)."""
    by = rows.groupBy("library", "symbol").agg(F.count("*").alias("row_count"), F.max("valid_time").alias("latest_valid_time"))
    if vintages is None:
        return by
    known = catalog(vintages).select("library", "symbol", "mode", "schema_name", "vintage_count", "reconstructed_pct")
    return by.join(known, ["library", "symbol"], "left")


def readable(vintages: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(library, mode, n_symbols, unreadable): symbols of each library, and how many of them cannot be read.

    ``unreadable``: (library, symbol), as ``Store.unreadable`` gives them.
    """
    lost = unreadable.select("library", "symbol", F.lit(1).alias("_lost")).distinct()
    every = vintages.select("library", "symbol").distinct().join(lost, ["library", "symbol"], "left")
    by = every.groupBy("library").agg(F.count_if(F.col("_lost").isNull()).alias("n_symbols"), F.count("_lost").alias("unreadable"))
    return modes_of_libraries(by).withColumn("mode", F.coalesce("mode", F.lit("unknown")))


def health(listed: DataFrame, max_age: DataFrame, now: datetime) -> DataFrame:
    """Catalog rows with their age in business days and a status: ok, stale, or error without rows.

    ``max_age``: (library, max_age), a row per library.  A time in the future has a
    negative age and is ok.
    """
    latest, today = F.to_date("latest_valid_time"), F.to_date(F.lit(now))
    age = F.when(latest <= today, business_days(latest, today)).otherwise(-business_days(today, latest))
    status = F.when(F.col("latest_valid_time").isNull(), "error").when(F.col("age_days") > F.col("max_age"), "stale").otherwise("ok")
    return listed.join(F.broadcast(max_age), "library", "left").withColumn("age_days", age).withColumn("status", status)


def overview(rows: DataFrame, most: int = 50) -> DataFrame:
    """One row over health rows: volume, velocity, variety (schemas and modes too), veracity; the first ``most`` broken series by name."""
    name = F.concat_ws("/", "library", "symbol")
    broken = rows.where("status != 'ok'").select(name.alias("_name")).orderBy("_name").limit(most)
    broken = broken.agg(F.array_join(F.array_sort(F.collect_list("_name")), ",").alias("broken"))
    counts = modes_of_libraries(gates(rows.drop("gate", "mode"))).agg(
        F.sum("row_count").alias("total_rows"), F.count("*").alias("n_symbols"), F.max("latest_valid_time").alias("newest"),
        F.countDistinct("library").alias("n_libraries"), F.countDistinct("gate").alias("n_schemas"),
        F.array_join(F.array_sort(F.collect_set("mode")), ",").alias("modes"), F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "stale").alias("n_stale"), F.count_if(F.col("status") == "error").alias("n_error"),
    )
    return counts.join(F.broadcast(broken))  # one row each


def cadence_gaps(rows: DataFrame, by: str = "symbol", time: str = "valid_time") -> DataFrame:
    """(by, modal_seconds, n_gaps): steps longer than the series' most common one (the least of equals); needs over 2 rows."""
    step = F.unix_timestamp(time) - F.unix_timestamp(F.lag(time).over(by_block(by, time)))
    counts = in_blocks(rows.select(by, time), 1, by, time).select(by, step.alias("step"), "_carried").where("not _carried and step is not null").groupBy(by, "step").agg(F.count("*").alias("n"))
    per = counts.groupBy(by).agg(F.max_by("step", F.struct("n", -F.col("step"))).alias("modal_seconds"), F.sum("n").alias("steps"))
    longer = F.coalesce(F.sum(F.when(F.col("step") > F.col("modal_seconds"), F.col("n"))), F.lit(0))
    return counts.join(per.where("steps > 1"), by).groupBy(by, "modal_seconds").agg(longer.alias("n_gaps"))


def symbol_quality(rows: DataFrame, gate: Gate, now: datetime, most: int = 50) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(failures against now with failing values, the first ``most``; cadence gaps; bar audit if the rows are bars).

    A check with several failing values at hand has a row for each; one that is not about values has a null ``failure_case``.
    """
    bars = None
    if {"Open", "High", "Low", "Close", "Volume"} <= set(rows.columns):
        bars = tick_quality(rows.withColumnsRenamed({"symbol": "Symbol", "valid_time": "Datetime"}))
    found = failures(rows, gate, now).join(failure_cases(rows, gate), ["check", "column"], "left")
    return found.orderBy("check", "column", "failure_case").limit(most), cadence_gaps(rows), bars
