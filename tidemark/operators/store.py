"""Bitemporal store on Parquet.

Layout: ``<root>/observations/<library>/commit_id=…/`` holds the rows of one commit
for all its symbols, sorted by symbol and time and cut into files of ``FILE_ROWS``;
``<root>/vintages/<library>/`` is a log (``log.py``) with a row for each symbol of a
commit.  A commit writes its rows first and publishes its vintages last, under the next
number of the library's log, so rows of a commit that broke off are never read
(``orphans`` finds them), and of several writers one gets the number; the others decide
anew on what it has written.

Each vintage carries the chain of commits that its series is made of: its base's chain at
the time of the commit, and itself.  A read takes the newest vintage known at T for each
symbol, and of each key the row from the last commit in the chain.  A chain that has grown
to ``fold`` commits is folded: the next commit to the series holds its whole state and
starts a new chain, so a read opens a bounded number of commits and the vintages stay
in proportion to their number.  A vintage also has its files, with the times of the
symbol's rows in each, so a read of symbols and times opens only files that hold some; the
columns of its rows, so no file is opened to learn them; and how many rows the series
has with it, counted as it was committed.

Modes: ``bitemporal_merge`` rows replace those of the same key, others survive;
``bitemporal_replace`` each commit is a whole series; ``degenerate`` only new keys
are added, the first row of a key stays.  ``compact`` merges small commits of a degenerate
library into one: the log then has a row that names what was merged, and readers open either the
small ones or the merged one, whichever their number of the log says.
"""

from __future__ import annotations

import functools
import json
import math
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import one_per_key
from tidemark.operators.log import Files, Log
from tidemark.operators.routing import LIBRARY_MODE

VINTAGES = (
    "library string, symbol string, commit_id string, commit_seq long, as_of timestamp, fetched_at timestamp, mode string, vintage_reconstructed boolean, "
    "row_count long, min_valid_time timestamp, max_valid_time timestamp, chain array<string>, batch string, "
    "total_rows long, last_valid_time timestamp, columns string, files array<struct<name:string,low:timestamp,high:timestamp,n:bigint>>, merges array<string>"
)
NAMES = [c.split()[0] for c in VINTAGES.split(", ")]
PROVENANCE = ("as_of", "fetched_at", "source", "source_url", "vintage_reconstructed")
#: Columns that tell rows of one symbol and time apart.
EXTRA_KEYS = {"power.generation_by_fuel": ("fuel_type",)}
#: Rows of a file, about; also those from which a commit is large enough to be left alone by ``compact``.
FILE_ROWS = 1_000_000
#: Times that a commit is decided anew after other writers were first.
ATTEMPTS = 50
#: Marks rows whose key the series did not have.
FIRST = "_first"
#: Symbols of a batch that the driver looks at by name.
FEW = 1000


def canonical(df: DataFrame, extra: tuple[str, ...] = (), order: str | None = None, **provenance) -> DataFrame:
    """One row per (library, symbol, valid_time, extra), the last in ``order``; provenance as columns.

    Without ``order`` rows of one key must not differ in a way that matters; the
    one that sorts last as a whole stays.
    """
    if "valid_time" not in df.columns:
        raise ValueError("rows without valid_time")
    key = ["library", "symbol", "valid_time", *extra]
    rest = [c for c in df.columns if c not in key]
    last = [F.desc(order)] if order else [F.desc(F.struct(*rest))] if rest else [F.lit(1)]
    out = one_per_key(df.where(F.col("valid_time").isNotNull()), key, last)
    return out.withColumns({k: v if not isinstance(v, (str, bool, datetime, type(None))) else F.lit(v) for k, v in provenance.items()})


def as_of_rows(rows: DataFrame, as_of: datetime, key: tuple[str, ...] = ("instrument_id", "valid_time"), tie: str | None = None) -> DataFrame:
    """Of rows stamped with ``as_of``: each key's last that was known at a moment, for vintages that came in order."""
    order = [F.desc("as_of"), *([F.desc(tie)] if tie else [])]
    return one_per_key(rows.where(F.col("as_of") <= F.lit(as_of)), list(key), order)


def filled_up(rows: DataFrame, columns: list[str], like: StructType) -> DataFrame:
    """``rows`` with null in the place of ``columns`` that it lacks."""
    return rows.withColumns({c: F.lit(None).cast(like[c].dataType) for c in columns if c not in rows.columns})


def content(values: list[str]) -> Column:
    """Digest of a row's values."""
    return F.sha2(F.to_json(F.struct(*values)), 256)


class Store:
    """A root folder, and the number of commits at which a chain is folded; see the module."""

    def __init__(self, spark: SparkSession, root: str, fold: int = 64, file_rows: int = FILE_ROWS):
        self.spark, self.root, self.fold, self.file_rows, self.files = spark, root.rstrip("/"), fold, file_rows, Files(spark)

    # -- tables -------------------------------------------------------------

    def log(self, library: str) -> Log:
        return Log(self.spark, f"{self.root}/vintages/{library}", VINTAGES)

    def _logged(self, library: str | None = None) -> DataFrame:
        """All rows of one log, or of all."""
        if library is not None:
            return self.log(library).read()
        logs = [self.log(name).read() for name in self.files.names(f"{self.root}/vintages") if not name.startswith("_")]
        return functools.reduce(DataFrame.unionAll, logs) if logs else self.spark.createDataFrame([], VINTAGES)

    def vintages(self, library: str | None = None) -> DataFrame:
        """All committed vintages; merging commits makes none."""
        return self._logged(library).where("merges is null")

    @staticmethod
    def _live(logged: DataFrame) -> DataFrame:
        """Rows of a degenerate library's log whose commits are to be read."""
        gone = logged.select(F.explode("merges").alias("commit_id")).distinct()
        return logged.join(gone, "commit_id", "left_anti")

    @staticmethod
    def _overlapping(vintages: DataFrame, start, end) -> DataFrame:
        """Vintages with rows in a range of valid times."""
        if start is not None:
            vintages = vintages.where(F.col("max_valid_time") >= F.lit(start))
        if end is not None:
            vintages = vintages.where(F.col("min_valid_time") <= F.lit(end))
        return vintages

    def _rows(self, library: str, vintages: DataFrame, start=None, end=None, whole: bool = False, one_task: bool = False) -> DataFrame | None:
        """Rows in the files of ``vintages`` (commit_id, columns, files) whose times overlap a range; None without any.

        The driver gets the names of the files to open, as it does of any table that Spark lists; with ``whole`` those of
        the folders.  Files of other commits, and of broken ones, are not even listed.  ``one_task``: the rows of the
        symbols are read by one task if they are no more than those of a file, so that nothing is shuffled.
        """
        base = f"{self.root}/observations/{library}"
        if whole:
            named = vintages.select("commit_id", "columns", F.lit("").alias("name"), "row_count")
        else:
            inside = lambda f: (F.lit(True) if start is None else f["high"] >= F.lit(start)) & (F.lit(True) if end is None else f["low"] <= F.lit(end))
            named = vintages.select("commit_id", "columns", F.explode(F.filter("files", inside)).alias("f")).select("commit_id", "columns", "f.name", F.col("f.n").alias("row_count"))
        found = sorted(map(tuple, named.groupBy("commit_id", "columns", "name").agg(F.sum("row_count")).collect()))
        if not found:
            return None
        schema = StructType()
        for columns in sorted({c for _, c, _, _ in found}):
            for field in StructType.fromJson(json.loads(columns)).fields:
                if field.name not in schema.names:
                    schema.add(field)
                elif schema[field.name].dataType != field.dataType:
                    raise ValueError(f"{library}: {field.name} is {schema[field.name].dataType.simpleString()} in one commit and {field.dataType.simpleString()} in another")
        schema.add("commit_id", "string")
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/commit_id={c}/{n}".rstrip("/") for c, _, n, _ in found))
        return rows.coalesce(1) if one_task and sum(n for *_, n in found) <= self.file_rows else rows

    @staticmethod
    def _heads(vintages: DataFrame, as_of: datetime | None, strictly: bool = False) -> DataFrame:
        """(symbol, chain, total_rows, last_valid_time) of the newest vintage known at a moment; of equal ones the last committed."""
        v = vintages
        if as_of is not None:
            v = v.where(F.col("as_of") < F.lit(as_of) if strictly else F.col("as_of") <= F.lit(as_of))
        last = F.max_by(F.struct("chain", "total_rows", "last_valid_time"), F.struct("as_of", "commit_seq")).alias("h")
        return v.groupBy("symbol").agg(last).select("symbol", "h.*")

    # -- reads --------------------------------------------------------------

    def _series(self, library: str, logged: DataFrame, heads: DataFrame, start=None, end=None, whole: bool = False, one_task: bool = False) -> DataFrame | None:
        links = heads.select("symbol", F.posexplode("chain").alias("_place", "commit_id"))
        named = self._overlapping(logged, start, end).join(links, ["symbol", "commit_id"])
        rows = self._rows(library, named, start, end, whole, one_task)
        if rows is None:
            return None
        key = ["symbol", "valid_time", *EXTRA_KEYS.get(library, ())]
        # vintages are metadata, a row per symbol and commit; AQE broadcasts them while they are small
        joined = self._within(rows, start, end).join(named.select("symbol", "commit_id", "_place"), ["symbol", "commit_id"])
        return one_per_key(joined, key, [F.desc("_place")]).drop("_place").withColumn("library", F.lit(library))

    @staticmethod
    def _within(rows: DataFrame, start, end) -> DataFrame:
        if start is not None:
            rows = rows.where(F.col("valid_time") >= F.lit(start))
        return rows if end is None else rows.where(F.col("valid_time") <= F.lit(end))

    def read(
        self, library: str, as_of: datetime | None = None, symbols: list[str] | DataFrame | None = None,
        start: datetime | None = None, end: datetime | None = None,
    ) -> DataFrame:
        """Rows of a library as known at ``as_of`` (latest without), of some symbols, in a range of valid times (ends included).

        ``symbols`` is a list, or a table with a column ``symbol``.  Before a symbol's first
        vintage it has no rows.  A library without any commit is an error, as its columns are not known.
        """
        logged = every = self._logged(library)

        def wanted(df: DataFrame) -> DataFrame:
            if symbols is None:
                return df
            return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi") if isinstance(symbols, DataFrame) else df.where(F.col("symbol").isin(*symbols))

        logged = wanted(logged)
        whole = symbols is None and start is None and end is None
        if LIBRARY_MODE[library] == "degenerate":
            out = self._rows(library, self._overlapping(wanted(self._live(every)), start, end), start, end, whole)
            if out is not None:
                out = self._within(wanted(out), start, end).withColumn("library", F.lit(library))
                out = out if as_of is None else out.where(F.col("fetched_at") <= F.lit(as_of))
        else:
            out = self._series(library, logged, self._heads(logged.where("merges is null"), as_of), start, end, whole)
        if out is None:
            some = self._rows(library, self._live(every) if LIBRARY_MODE[library] == "degenerate" else every, whole=True)
            if some is None:
                raise KeyError(f"nothing committed to {library}")
            out = some.withColumn("library", F.lit(library)).where(F.lit(False))  # typed, but empty
        return out.drop(FIRST)

    def series(self, library: str, symbol: str, as_of: datetime | None = None, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """One symbol's rows; a symbol that was never committed is an error, one not yet known at ``as_of`` is empty."""
        if self.vintages(library).where(F.col("symbol") == symbol).isEmpty():
            raise KeyError(f"unknown symbol {symbol!r} in {library}")
        return self.read(library, as_of, [symbol], start, end)

    def latest(self, library: str) -> DataFrame:
        """(symbol, as_of, commit_seq) of each symbol's newest vintage."""
        newest = F.max(F.struct("as_of", "commit_seq")).alias("v")
        return self.vintages(library).groupBy("symbol").agg(newest).select("symbol", "v.as_of", "v.commit_seq")

    def curve(self, library: str, contracts: DataFrame, as_of: datetime | None = None) -> DataFrame:
        """Rows of all ``contracts`` (symbol) in one read, of their files only."""
        return self.read(library, as_of, contracts)

    # -- commits ------------------------------------------------------------

    def stage(self, rows: DataFrame) -> str:
        """Write routed rows to a folder of their own, by library; ``commit`` takes it, ``Files.delete`` gives it up."""
        staged = f"{self.root}/staging/{uuid.uuid4().hex}"
        rows.write.partitionBy("library").parquet(staged)
        return staged

    def staged(self, staged: str, schema: StructType) -> DataFrame:
        """What ``stage`` has written; empty if it had no rows."""
        return self.spark.read.schema(schema).parquet(staged)

    def commit(
        self, rows: DataFrame, *, as_of: datetime, fetched_at: datetime, source: str, source_url: str = "",
        reconstructed: bool = False, order: str | None = None, force: bool = False, batch: str | None = None,
    ) -> list[str]:
        """Commit routed rows (library, symbol, mode, valid_time, values); returns the commit ids.

        A symbol that has a vintage at ``as_of`` already, or whose rows say nothing
        new, is left out; ``force`` commits it all the same.  One plan per library,
        whatever the number of symbols.

        ``batch`` names a part of a stream.  Parts of one ``as_of`` build on each other, in a
        replaced series too: together they are what was known at that moment.  A row that was committed at
        this ``as_of`` before, whatever part it was in, is left out, so parts can be cut anew and run again.

        The rows are written once, to a folder that is removed at the end, and all
        steps read them from there.
        """
        staged = self.stage(rows)
        try:
            return self.commit_staged(
                staged, rows.schema, as_of=as_of, fetched_at=fetched_at, source=source, source_url=source_url,
                reconstructed=reconstructed, order=order, force=force, batch=batch,
            )
        finally:
            self.files.delete(staged)

    def commit_staged(self, staged: str, schema: StructType, **how) -> list[str]:
        """``commit`` of what ``stage`` has written; one library after the other, as each has its own log."""
        ids = []
        own = StructType([f for f in schema.fields if f.name not in ("library", "mode")])
        for library in LIBRARY_MODE:
            if f"library={library}" in self.files.names(staged):
                part = self.spark.read.schema(own).parquet(f"{staged}/library={library}").withColumn("library", F.lit(library))
                ids += self._commit(library, part, **how)
        return ids

    def _commit(self, library, part, *, as_of, fetched_at, source, source_url="", reconstructed=False, order=None, force=False, batch=None) -> list[str]:
        stamps = {"as_of": as_of, "fetched_at": fetched_at, "source": source, "source_url": source_url, "vintage_reconstructed": reconstructed}
        per = part.groupBy("symbol").agg(F.min("valid_time").alias("low"), F.max("valid_time").alias("high"), F.count("*").alias("n"))
        some = per.limit(FEW + 1).collect()
        if len(some) > FEW:
            low, high, size = part.agg(F.min("valid_time"), F.max("valid_time"), F.count("*")).first()
            names = part.select("symbol").distinct()
            of_batch = lambda df: df.join(names, "symbol", "left_semi")
        else:
            times = [t for r in some for t in (r["low"], r["high"]) if t is not None]
            low, high, size = min(times, default=None), max(times, default=None), sum(r["n"] for r in some)
            of_batch = lambda df: df.where(F.col("symbol").isin(*(r["symbol"] for r in some)))
        if low is None:
            return []
        if size <= self.file_rows:
            part = part.coalesce(1)  # one file in the end, so one task from the start
        new = canonical(part, EXTRA_KEYS.get(library, ()), order, **stamps)
        new = (new.drop(order) if order else new).drop("library")
        decide = self._append if LIBRARY_MODE[library] == "degenerate" else self._revise
        for _ in range(ATTEMPTS):
            log = self.log(library)
            number, files = log.listed()
            logged = log.frame(files)
            rows, heads, n = decide(library, new, logged, of_batch, low, high, size, as_of, force, batch)
            made = {"as_of": F.lit(as_of), "fetched_at": F.lit(fetched_at), "vintage_reconstructed": F.lit(reconstructed), "batch": F.lit(batch).cast("string")}
            done = self._write(library, rows, n, number + 1, heads, made)
            if done is None:
                return []
            commit_id, rows_of = done
            if log.append(rows_of, number + 1):
                if LIBRARY_MODE[library] == "degenerate" and (number + 1) % self.fold == 0:
                    self.compact(library)
                return [commit_id]
            self.discard(library, commit_id)  # another writer was first: what it wrote may change what is new
        raise RuntimeError(f"{library}: other writers were first {ATTEMPTS} times")

    def _append(self, library, new, logged, of_batch, low, high, size, as_of, force, batch):
        """Rows whose keys a degenerate library does not have."""
        key = ["symbol", "valid_time", *EXTRA_KEYS.get(library, ())]
        old = self._rows(library, self._overlapping(of_batch(self._live(logged)), low, high), low, high, one_task=size <= self.file_rows)
        return (new if old is None else new.join(old.select(*key), key, "left_anti")).withColumn(FIRST, F.lit(True)), None, size

    def _revise(self, library, new, logged, of_batch, low, high, size, as_of, force, batch):
        """Rows of the series that have something new to say, what they build on, and about how many they are."""
        replace, key = LIBRARY_MODE[library] == "bitemporal_replace", ["symbol", "valid_time", *EXTRA_KEYS.get(library, ())]
        values = [c for c in new.columns if c not in (*key, *PROVENANCE)]
        own = of_batch(logged)
        now = own.where(F.col("as_of") == F.lit(as_of))
        whole = replace and batch is None  # a commit is the whole series
        if not force and batch is None:
            new = new.join(now.select("symbol").distinct(), "symbol", "left_anti")
        heads = self._heads(now if replace and batch is not None else own, as_of, strictly=batch is None)
        span = (None, None) if whole else (low, high)
        longest = 0 if whole else heads.agg(F.max(F.size("chain"))).first()[0] or 0
        base = self._series(library, own, heads, *((None, None) if longest >= self.fold else span), one_task=size <= self.file_rows)
        if base is None:
            return new.withColumn(FIRST, F.lit(True)), None if whole else heads, size
        base = filled_up(base, [*values, *PROVENANCE], new.schema)
        if batch is not None and not force:
            seen = self._rows(library, self._overlapping(now, low, high), low, high, one_task=size <= self.file_rows)
            if seen is not None:
                seen = filled_up(seen.where(F.col("as_of") == F.lit(as_of)), values, new.schema)
                seen = seen.select(*key, content(values).alias("_content")).distinct()
                new = new.withColumn("_content", content(values)).join(seen, [*key, "_content"], "left_anti").drop("_content")
        old = base.select(*key, F.struct(*values).alias("_old"), F.lit(True).alias("_in_old"))
        both = new.withColumn("_in_new", F.lit(True)).join(old, key, "full_outer" if whole and not force else "left")
        both = both.withColumn("_new", F.struct(*values)).withColumn(FIRST, F.col("_in_old").isNull())
        rows = both.where("_in_new").drop("_in_new", "_in_old", "_new", "_old")
        if not force:
            # a symbol is committed if any value of it differs, or if a whole series lacks a key
            differs = F.bool_or(F.col("_in_new").isNull() | F.col("_in_old").isNull() | ~F.col("_new").eqNullSafe(F.col("_old")))
            if size <= self.file_rows:  # one task holds the batch already
                rows = both.withColumn("_d", differs.over(Window.partitionBy("symbol"))).where("_d and _in_new").select(rows.columns)
            else:
                rows = rows.join(both.groupBy("symbol").agg(differs.alias("_d")).where("_d").select("symbol"), "symbol", "left_semi")
        if whole:
            return rows.withColumn(FIRST, F.lit(True)), None, size
        if longest >= self.fold:  # the next commit of a long chain holds the whole series
            long = heads.where(F.size("chain") >= self.fold)
            stays = base.drop("commit_id", "library", FIRST).join(long, "symbol", "left_semi").join(rows.select("symbol").distinct(), "symbol", "left_semi")
            stays = stays.join(rows.select(*key), key, "left_anti").withColumn(FIRST, F.lit(False))
            rows = rows.unionByName(stays, allowMissingColumns=True)
            heads = heads.withColumn("chain", F.when(F.size("chain") < self.fold, F.col("chain")).otherwise(F.array().cast("array<string>")))
            size += long.agg(F.sum("total_rows")).first()[0] or 0
        return rows, heads, size

    def _write(self, library: str, rows: DataFrame, size: int, number: int, heads: DataFrame | None, made: dict[str, Column]) -> tuple[str, DataFrame] | None:
        """Rows of a commit, by symbol and time, and its vintages, not yet published; None if there are no rows.

        ``row_count`` has the rows known since ``as_of``, not what a folded chain brought.
        """
        commit_id = uuid.uuid4().hex
        base = f"{self.root}/observations/{library}"
        count = math.ceil(size / self.file_rows)
        if count > 1:  # cut by range: Spark samples what it cuts, so that is a table
            held = f"{self.root}/staging/{uuid.uuid4().hex}"
            rows.write.parquet(held)
            rows = self.spark.read.schema(rows.schema).parquet(held).repartitionByRange(count, "symbol", "valid_time")
        else:
            held, rows = None, rows.repartition(1)
        rows.sortWithinPartitions("symbol", "valid_time").write.parquet(f"{base}/commit_id={commit_id}")
        if held:
            self.files.delete(held)
        stored = self.spark.read.schema(rows.schema).option("basePath", base).parquet(f"{base}/commit_id={commit_id}")
        if stored.isEmpty():
            self.discard(library, commit_id)
            return None
        known = F.lit(True) if "as_of" not in made else F.col("as_of") == made["as_of"]
        if count <= 1:
            stored = stored.coalesce(1)
        by_file = stored.groupBy("symbol", F.col("_metadata.file_name").alias("name")).agg(
            F.min("valid_time").alias("low"), F.max("valid_time").alias("high"), F.count("*").alias("n"), F.count_if(known).alias("n_known"), F.count_if(FIRST).alias("n_first")
        )
        written = by_file.groupBy("symbol").agg(
            F.sum("n_known").alias("row_count"), F.sum("n_first").alias("n_first"), F.min("low").alias("min_valid_time"), F.max("high").alias("max_valid_time"),
            F.array_sort(F.collect_list(F.struct("name", "low", "high", "n"))).alias("files"),
        )
        own = F.array(F.lit(commit_id))
        if heads is None:
            written = written.withColumns({"chain": own, "total_rows": F.col("n_first"), "last_valid_time": F.col("max_valid_time")})
        else:
            before = heads.select("symbol", F.col("chain").alias("_chain"), F.col("total_rows").alias("_total"), F.col("last_valid_time").alias("_last"))
            written = written.join(before, "symbol", "left").withColumns(
                {
                    "chain": F.concat(F.coalesce("_chain", F.array().cast("array<string>")), own), "total_rows": F.coalesce("_total", F.lit(0)) + F.col("n_first"),
                    "last_valid_time": F.greatest("_last", "max_valid_time"),
                }
            )
        columns = StructType([f for f in rows.schema.fields if f.name != "library"]).json()
        rest = {"as_of": None, "fetched_at": None, "vintage_reconstructed": None, "batch": None, "merges": None}
        types = dict(c.split(" ", 1) for c in VINTAGES.split(", ") if "<" not in c) | {"merges": "array<string>"}
        rest = {k: F.lit(v).cast(types[k]) for k, v in rest.items()} | made
        stamps = {"library": library, "commit_id": commit_id, "mode": LIBRARY_MODE[library], "columns": columns}
        stamped = written.withColumns({k: F.lit(v) for k, v in stamps.items()} | rest | {"commit_seq": F.lit(number).cast("long")})
        return commit_id, stamped.select(*NAMES)

    # -- maintenance --------------------------------------------------------

    def compact(self, library: str, *, as_of: datetime | None = None, fetched_at: datetime | None = None) -> str | None:
        """Merge what reads would have to open one by one; the commit id, or None if there was nothing to merge.

        In a degenerate library commits of fewer than ``file_rows`` rows become one, whose rows keep all their
        columns; no vintage is made, reads as of any moment stay as they are, and the folders merged stay until ``vacuum``.
        Else the whole latest series of every symbol is committed as a new chain root at ``as_of``.
        """
        log = self.log(library)
        number, files = log.listed()
        logged = log.frame(files)
        if LIBRARY_MODE[library] != "degenerate":
            rows = self._series(library, logged, self._heads(logged, None), whole=True)
            size = self._heads(logged, None).agg(F.sum("total_rows")).first()[0] or 0
            made = {"fetched_at": F.lit(fetched_at), "vintage_reconstructed": F.lit(False)}
            rows = rows.drop("library", "commit_id").withColumn(FIRST, F.lit(True))
            commit_id, vintages = self._write(library, rows, size, number + 1, None, made)
            vintages = vintages.withColumns({"mode": F.lit("bitemporal_replace"), "as_of": F.lit(as_of)})
            if not log.append(vintages.select(*NAMES), number + 1):
                self.discard(library, commit_id)
                return self.compact(library, as_of=as_of, fetched_at=fetched_at)
            return commit_id
        live = self._live(logged)
        small = live.groupBy("commit_id").agg(F.sum("row_count").alias("n")).where(F.col("n") < self.file_rows)
        merged, size = small.agg(F.collect_list("commit_id"), F.sum("n")).first()  # ids of commits to be opened
        if len(merged) < 2:
            return None
        rows = self._rows(library, live.where(F.col("commit_id").isin(*merged)), whole=True)
        done = self._write(library, rows.drop("commit_id"), size, number + 1, None, {"merges": F.lit(merged)})
        while not log.append(done[1].withColumn("commit_seq", F.lit(number + 1).cast("long")), number + 1):
            # commits that came meanwhile are not among those merged; only another merge is in the way
            before, (number, files) = number, log.listed()
            if not log.frame(files).where((F.col("commit_seq") > before) & F.col("merges").isNotNull()).isEmpty():
                self.discard(library, done[0])
                return None
        log.checkpoint()
        return done[0]

    def vacuum(self, library: str) -> list[str]:
        """Remove the folders of commits that were merged into others; readers that began before the merge lose them."""
        merged = self._logged(library).select(F.explode("merges").alias("commit_id")).distinct()
        ids = [r["commit_id"] for r in self._folders(library).join(merged, "commit_id", "left_semi").collect()]
        for i in ids:
            self.discard(library, i)
        return ids

    def _folders(self, library: str) -> DataFrame:
        """(commit_id) of all that has a folder."""
        names = self.files.names(f"{self.root}/observations/{library}")
        return self.spark.createDataFrame([(n.split("=", 1)[1],) for n in names if n.startswith("commit_id=")], "commit_id string")

    def orphans(self, library: str) -> DataFrame:
        """(commit_id) of rows written by commits that never reached the log; a commit that is under way is among them."""
        return self._folders(library).join(self._logged(library), "commit_id", "left_anti")

    def unreadable(self, library: str) -> DataFrame:
        """(library, symbol) of series that name a commit whose rows are gone."""
        logged = self._logged(library)
        if LIBRARY_MODE[library] == "degenerate":
            links = self._live(logged).select("library", "symbol", "commit_id")
        else:
            links = logged.select("library", "symbol", F.explode("chain").alias("commit_id"))
        return links.join(self._folders(library), "commit_id", "left_anti").select("library", "symbol").distinct()

    def discard(self, library: str, commit_id: str) -> None:
        """Removes the rows of a commit; series whose chains name it are unreadable from then on."""
        self.files.delete(f"{self.root}/observations/{library}/commit_id={commit_id}")

    def remove_orphans(self, library: str) -> list[str]:
        ids = [r["commit_id"] for r in self.orphans(library).collect()]
        for i in ids:
            self.discard(library, i)
        return ids


def reconstructed(period_end: datetime | Column, run_time: datetime, grace_days: int | None) -> bool | Column:
    """Whether a vintage was fetched so long after its period that it can't tell what was known then; by row for a column."""
    if isinstance(period_end, Column):
        return F.lit(False) if grace_days is None else F.lit(run_time) > period_end + F.make_dt_interval(days=F.lit(grace_days))
    return grace_days is not None and (run_time - period_end).total_seconds() > grace_days * 86_400


def typed(rows: DataFrame) -> DataFrame:
    """Contract months as dates, for reading."""
    return rows.withColumn("ContractMonth", F.to_date("ContractMonth")) if "ContractMonth" in rows.columns else rows
