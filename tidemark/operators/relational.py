"""Keyed tables: upserts, checks of columns, summaries, free SQL."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.log import Files, Log

BAR_COLUMNS = ("Datetime", "Symbol", "Open", "High", "Low", "Close", "Volume")
BAR_KEY = ("Symbol", "Datetime")
CONTRACT_COLUMNS = ("Datetime", "Commodity", "ContractMonth", "Symbol", "Open", "High", "Low", "Close", "Volume", "OpenInterest")
CONTRACT_KEY = ("Commodity", "ContractMonth", "Datetime")


def in_order(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` by name, in their order; an error if any is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def upsert(old: DataFrame, new: DataFrame, key: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """``old`` with the rows of ``new`` put in its place by key; of several new rows of a key any one that sorts last stays."""
    new = in_order(new, columns)
    rest = [c for c in columns if c not in key]
    new = new.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row")).select(*key, "_row.*")
    kept = in_order(old, columns).join(new.select(*key), list(key), "left_anti")
    return kept.select(*columns).unionByName(new.select(*columns))


def upsert_bars(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, BAR_KEY, BAR_COLUMNS)


def upsert_contracts(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, CONTRACT_KEY, CONTRACT_COLUMNS)


#: Log of a keyed table: each bucket's newest version is what it holds.
BUCKETS = "bucket string, version long, folder string, columns string, n_rows long"


class KeyedTable:
    """A keyed table under a root folder, of which an upsert rewrites only the buckets that its keys fall into.

    A bucket holds the keys of one ``span`` of ``time`` (a unit of ``date_trunc``) and of one of ``width`` hashes of the rest
    of the key, so rows about a stretch of time, as loads bring them, touch few of them whatever the table's size.
    New versions of the touched buckets are written beside the old ones and published in one step
    (``log.py``); of two writers the later one merges again with what the other has written.  Old
    versions stay until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, root: str, key: tuple[str, ...], columns: tuple[str, ...], time: str = "Datetime", span: str = "month", width: int = 8):
        self.spark, self.root, self.key, self.columns, self.time, self.span, self.width = spark, root.rstrip("/"), key, columns, time, span, width
        self.log, self.files = Log(spark, f"{self.root}/log", BUCKETS), Files(spark)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        rest = [c for c in self.key if c != self.time]
        when = F.coalesce(F.date_format(F.date_trunc(self.span, F.col(self.time).cast("timestamp")), "yyyyMMddHH"), F.lit("none"))
        return df.withColumn("bucket", F.concat_ws("-", when, F.pmod(F.xxhash64(*rest), F.lit(self.width)).cast("string")))

    def _current(self, files: list[str]) -> DataFrame:
        return self.log.frame(files).groupBy("bucket").agg(F.max_by(F.struct("version", "folder", "columns"), "version").alias("v")).select("bucket", "v.*")

    def _rows(self, current: DataFrame) -> DataFrame | None:
        # a name for each bucket, as many as a listing of the table's folders has
        found = current.collect()
        if not found:
            return None
        schema = StructType.fromJson(json.loads(max(found, key=lambda r: r["version"])["columns"]))
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/rows/{r['folder']}/bucket={r['bucket']}" for r in found))

    def read(self) -> DataFrame:
        rows = self._rows(self._current(self.log.listed()[1]))
        if rows is None:
            raise KeyError(f"nothing was written to {self.root}")
        return rows.select(*self.columns)

    def upsert(self, new: DataFrame) -> int:
        """Put rows in the place of those of their key; how many buckets were rewritten."""
        rest = [c for c in self.columns if c not in self.key]
        staged = f"{self.root}/staging/{uuid.uuid4().hex}"
        one = in_order(new, self.columns).groupBy(*self.key).agg(F.max(F.struct(*rest)).alias("_row")).select(*self.key, "_row.*")
        self._bucketed(one.select(*self.columns)).write.parquet(staged)
        rows = self.spark.read.parquet(staged)
        touched = rows.select(F.col("bucket").alias("bucket")).distinct()
        try:
            while True:
                number, files = self.log.listed()
                old = self._rows(self._current(files).join(touched, "bucket", "left_semi"))
                merged = rows
                if old is not None:
                    merged = self._bucketed(old.select(*self.columns)).join(rows.select(*self.key), list(self.key), "left_anti").unionByName(rows)
                folder = uuid.uuid4().hex
                path = f"{self.root}/rows/{folder}"
                merged.repartition("bucket").write.partitionBy("bucket").parquet(path)
                written = self.spark.read.schema(f"{self.key[0]} {rows.schema[self.key[0]].dataType.simpleString()}, bucket string").parquet(path)
                stamps = {"version": F.lit(number + 1).cast("long"), "folder": F.lit(folder), "columns": F.lit(StructType([rows.schema[c] for c in self.columns]).json())}
                entry = written.groupBy("bucket").agg(F.count("*").alias("n_rows")).withColumns(stamps).select("bucket", *stamps, "n_rows")
                if self.log.append(entry, number + 1):
                    return len([n for n in self.files.names(path) if n.startswith("bucket=")])
                self.files.delete(path)  # another writer was first: its rows are in the next merge
        finally:
            self.files.delete(staged)


    def vacuum(self) -> list[str]:
        """Remove folders without a bucket that is read; (their names).  Readers that began before and writers under way lose theirs."""
        live = {r["folder"] for r in self._current(self.log.listed()[1]).select("folder").distinct().collect()}
        gone = [n for n in self.files.names(f"{self.root}/rows") if n not in live]
        for n in gone:
            self.files.delete(f"{self.root}/rows/{n}")
        return gone


def naive_to_utc(df: DataFrame, column: str, zone: str) -> DataFrame:
    """Wall-clock times of ``zone`` as instants."""
    return df.withColumn(column, F.to_utc_timestamp(F.col(column).cast("timestamp"), zone))


def query(spark: SparkSession, sql: str, params: list | dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL over the named tables, with positional (``?``) or named (``:x``) parameters."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def recent(df: DataFrame, now: datetime, hours: int, time: str = "Datetime") -> DataFrame:
    """Rows of the last ``hours`` before ``now``."""
    return df.where(F.col(time) >= F.lit(now) - F.make_dt_interval(hours=F.lit(hours)))


def by_symbol(bars: DataFrame) -> DataFrame:
    """Count, span of time, mean close and total volume of each symbol."""
    return bars.groupBy("Symbol").agg(
        F.count("*").alias("n_rows"), F.min("Datetime").alias("first_time"), F.max("Datetime").alias("last_time"),
        F.avg("Close").alias("avg_close"), F.sum("Volume").alias("total_volume"),
    )
