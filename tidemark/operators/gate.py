"""Quality gates: declared columns, bands, keys and ages; every failure is reported at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import business_days, number


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Gate:
    """Fields beside instrument_id and valid_time, more key columns, greatest age in business days, a sentinel for null."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    max_age: int = 2
    sentinel: float | None = None

    @property
    def all_fields(self) -> tuple[Field, ...]:
        return (Field("instrument_id", "string"), Field("valid_time", "timestamp"), *self.fields)

    @property
    def all_key(self) -> tuple[str, ...]:
        return ("instrument_id", "valid_time", *self.key)


_OHLCV = (*(Field(c, "double", low=0) for c in ("Open", "High", "Low", "Close")), Field("Volume", "bigint", low=0))
_VALUE = (Field("value", "double", low=0),)
_MW = Field("value", "double", True, -1e7, 1e7)

#: The declared gates.
GATES = {
    g.name: g
    for g in (
        Gate("OHLCV", _OHLCV, max_age=2),
        Gate("DATED_CONTRACTS", (Field("ContractMonth", "timestamp"), *_OHLCV), max_age=5),
        Gate("EIA_GAS_STORAGE", _VALUE, max_age=10),
        Gate("EIA_PETROLEUM", _VALUE, max_age=10),
        Gate("FRED_SPOT", _VALUE, max_age=7),
        Gate("ERCOT_SPP", (Field("settlement_point", "string"), Field("price", "double", low=-251, high=5001)), max_age=2),
        Gate("ERCOT_LOAD", (Field("value", "double", low=0, high=200_000),), max_age=2),
        Gate("POWER_REGION", (Field("respondent", "string"), _MW), max_age=2),
        Gate("POWER_GEN_BY_FUEL", (Field("respondent", "string"), Field("fuel_type", "string"), _MW), ("fuel_type",), 2),
        Gate(
            "NOAA_HDDCDD",
            (Field("hdd", "double", True, 0, 9999), Field("cdd", "double", True, 0, 9999)),
            max_age=45,
            sentinel=-9999.0,
        ),
    )
}


#: Cases that an error shows of each check.
CASES = 10


class QualityGateError(ValueError):
    """A batch that its gate refuses; ``failures`` has check, column, n_failed and some cases of each."""

    def __init__(self, gate: str, failures: list):
        self.failures = failures
        shown = lambda f: f" ({', '.join(f['cases'])})" if f.get("cases") else ""
        super().__init__(f"{gate}: " + "; ".join(f"{f['check']}({f['column']}): {f['n_failed']}{shown(f)}" for f in failures))


def describe(spark: SparkSession, gate: Gate) -> DataFrame:
    """The gate as rows (column, dtype, nullable, low, high, in_key)."""
    bound = lambda x: None if x is None else float(x)
    rows = [(f.name, f.dtype, f.nullable, bound(f.low), bound(f.high), f.name in gate.all_key) for f in gate.all_fields]
    return spark.createDataFrame(rows, "column string, dtype string, nullable boolean, low double, high double, in_key boolean")


def coerced(df: DataFrame, gate: Gate) -> DataFrame:
    """Declared columns cast to their types (what can't be is null), sentinels nulled; further columns stay."""
    return df.withColumns({f.name: coerced_column(f, gate) for f in gate.all_fields if f.name in df.columns})


def row_checks(gate: Gate, columns: list[str]) -> list[tuple[str, str, Column]]:
    """(check, column, fails) over rows whose coerced columns are under ``_c``."""
    checks = []
    for f in gate.all_fields:
        if f.name not in columns:
            continue
        raw, value = F.col(f.name), F.col(f"_c.{f.name}")
        # NaN is a missing value, as null is
        nan = F.coalesce(F.isnan(raw.try_cast("double")), F.lit(False)) if f.dtype == "double" else F.lit(False)
        sentinel = raw.try_cast("double") == F.lit(gate.sentinel) if gate.sentinel is not None and f.dtype == "double" else F.lit(False)
        checks.append(("dtype", f.name, raw.isNotNull() & value.isNull() & ~sentinel & ~nan))
        if not f.nullable:
            checks.append(("not_null", f.name, raw.isNull() | nan))
        if f.low is not None or f.high is not None:
            inside = F.lit(True)
            if f.low is not None:
                inside = inside & (value >= f.low)
            if f.high is not None:
                inside = inside & (value <= f.high)
            checks.append(("band", f.name, value.isNotNull() & ~inside))
    return checks


def marked(df: DataFrame, gate: Gate) -> DataFrame:
    """Coerced rows with ``failed``, the names of the row checks that each one fails."""
    both = df.withColumn("_c", F.struct(*(coerced_column(f, gate) for f in gate.all_fields if f.name in df.columns)))
    names = F.array_compact(F.array(*(F.when(bad, F.lit(f"{check}:{column}")) for check, column, bad in row_checks(gate, df.columns))))
    declared = {f.name for f in gate.all_fields}
    return both.withColumn("failed", names).select(
        *(F.col(f"_c.{c}").alias(c) if c in declared else F.col(c) for c in df.columns), "failed"
    )


def coerced_column(f: Field, gate: Gate) -> Column:
    c = number(f.name) if f.dtype == "double" else F.col(f.name).try_cast(f.dtype)
    if gate.sentinel is not None and f.dtype == "double":
        c = F.nullif(c, F.lit(gate.sentinel))
    return c.alias(f.name)


def failures(df: DataFrame, gate: Gate, as_of: datetime | None = None) -> DataFrame:
    """(check, column, n_failed) of all that fails: missing columns, row checks, key, row floor and age.

    One aggregate for all checks of rows, one grouping for the key.  ``as_of`` is
    the clock of the age; without it age is not checked.
    """
    spark = df.sparkSession
    missing = [("column", f.name, 1) for f in gate.all_fields if f.name not in df.columns]
    found = spark.createDataFrame(missing, "check string, column string, n_failed long")
    both = df.withColumn("_c", F.struct(*(coerced_column(f, gate) for f in gate.all_fields if f.name in df.columns)))
    checks = row_checks(gate, df.columns)
    counts = [F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)]
    has_time = "valid_time" in df.columns
    newest = F.max("_c.valid_time") if has_time else F.lit(None).cast("timestamp")
    one = both.agg(*counts, F.count("*").alias("rows"), newest.alias("newest"))
    rows = [F.struct(F.lit(c).alias("check"), F.lit(col).alias("column"), F.col(f"n{i}").alias("n_failed")) for i, (c, col, _) in enumerate(checks)]
    rows.append(F.struct(F.lit("rows").alias("check"), F.lit("").alias("column"), (F.col("rows") == 0).cast("long").alias("n_failed")))
    if as_of is not None and has_time:
        age = business_days(F.to_date("newest"), F.to_date(F.lit(as_of)))
        stale = F.coalesce(age > gate.max_age, F.lit(True)).cast("long")
        rows.append(F.struct(F.lit("age").alias("check"), F.lit("valid_time").alias("column"), stale.alias("n_failed")))
    found = found.unionByName(one.select(F.inline(F.array(*rows))).where("n_failed > 0"))
    if all(k in df.columns for k in gate.all_key):
        repeats = both.groupBy(*(F.col(f"_c.{k}") for k in gate.all_key)).count().where("count > 1")
        unique = repeats.agg(F.count("*").alias("n_failed")).where("n_failed > 0")
        found = found.unionByName(unique.select(F.lit("unique").alias("check"), F.lit(",".join(gate.all_key)).alias("column"), "n_failed"))
    return found


def watched(df: DataFrame, gate: Gate) -> tuple[DataFrame, Callable[[datetime | None], list[dict]]]:
    """Coerced rows that are checked as they are written, and what failed once they are; no scan for the checks themselves.

    The second one may be called after an action has read all rows once.  It has the checks of ``failures``
    but the key's, which ``repeated_keys`` counts on what was written.
    """
    seen = Observation()
    missing = [{"check": "column", "column": f.name, "n_failed": 1} for f in gate.all_fields if f.name not in df.columns]
    both = df.withColumn("_c", F.struct(*(coerced_column(f, gate) for f in gate.all_fields if f.name in df.columns)))
    checks = row_checks(gate, df.columns)
    newest = F.max("_c.valid_time") if "valid_time" in df.columns else F.max(F.lit(None).cast("timestamp"))
    both = both.observe(seen, F.count(F.lit(1)).alias("rows"), F.to_date(newest).alias("newest"), *(F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)))
    declared = {f.name for f in gate.all_fields}

    def found(as_of: datetime | None) -> list[dict]:
        got = seen.get
        out = missing + [{"check": c, "column": col, "n_failed": got[f"n{i}"]} for i, (c, col, _) in enumerate(checks) if got[f"n{i}"]]
        if not got["rows"]:
            out.append({"check": "rows", "column": "", "n_failed": 1})
        if as_of is not None and "valid_time" in df.columns and (got["newest"] is None or np.busday_count(got["newest"], as_of.date()) > gate.max_age):
            out.append({"check": "age", "column": "valid_time", "n_failed": 1})
        return out

    return both.select(*(F.col(f"_c.{c}").alias(c) if c in declared else F.col(c) for c in df.columns)), found


def repeated_keys(rows: DataFrame, gate: Gate) -> list[dict]:
    """What ``failures`` says of the key of coerced rows."""
    if not all(k in rows.columns for k in gate.all_key):
        return []
    n = rows.groupBy(*gate.all_key).count().where("count > 1").count()
    return [{"check": "unique", "column": ",".join(gate.all_key), "n_failed": n}] if n else []


def refuse(df: DataFrame, gate: Gate, found: list[dict]) -> None:
    """A QualityGateError with every failed check, and with some of the failing values of ``df``; nothing if none failed."""
    if not found:
        return
    some: dict[tuple[str, str], list[str]] = {}
    for r in failure_cases(df, gate, [(f["check"], f["column"]) for f in found]).collect():  # at most CASES rows per check
        some.setdefault((r["check"], r["column"]), []).append(r["failure_case"])
    raise QualityGateError(gate.name, [f | {"cases": some.get((f["check"], f["column"]), [])} for f in found])


def failure_cases(df: DataFrame, gate: Gate, wanted: list[tuple[str, str]] | None = None, most: int = CASES) -> DataFrame:
    """(check, column, failure_case): values that fail, up to ``most`` of each check on rows or keys.

    ``wanted`` names the checks (check, column) to look at; without it all are.
    """
    both = df.withColumn("_c", F.struct(*(coerced_column(f, gate) for f in gate.all_fields if f.name in df.columns)))
    out = df.sparkSession.createDataFrame([], "check string, column string, failure_case string")

    def some(check: str, column: str, bad: DataFrame, value: Column) -> DataFrame:
        return bad.select(F.lit(check).alias("check"), F.lit(column).alias("column"), F.coalesce(value.cast("string"), F.lit("null")).alias("failure_case")).limit(most)

    for check, column, bad in row_checks(gate, df.columns):
        if wanted is None or (check, column) in wanted:
            out = out.unionAll(some(check, column, both.where(bad), F.col(column)))
    key = ",".join(gate.all_key)
    if all(k in df.columns for k in gate.all_key) and (wanted is None or ("unique", key) in wanted):
        repeated = both.groupBy(*(F.col(f"_c.{k}").alias(k) for k in gate.all_key)).count().where("count > 1")
        out = out.unionAll(some("unique", key, repeated, F.concat_ws(",", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in gate.all_key))))
    return out


def validate(df: DataFrame, gate: Gate, as_of: datetime | None = None) -> DataFrame:
    """The coerced frame, or a QualityGateError with every failed check."""
    refuse(df, gate, [r.asDict() for r in failures(df, gate, as_of).collect()])  # at most one row per check
    return coerced(df, gate)


def lagging(df: DataFrame, days: int = 3, by: str = "symbol") -> DataFrame:
    """Series whose newest row is more than ``days`` behind the newest of all."""
    newest = df.groupBy(by).agg(F.max("valid_time").alias("newest"))
    all_newest = df.agg(F.max("valid_time").alias("all_newest"))
    # one row on the right
    return newest.join(F.broadcast(all_newest)).where(F.col("newest") < F.col("all_newest") - F.make_dt_interval(days=F.lit(days))).select(by, "newest")
