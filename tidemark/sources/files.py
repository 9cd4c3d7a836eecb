"""Landed payload files as Spark data sources: ``spark.read.format("landed_reports")`` and ``("degree_day_files")``, as streams too.

Planning lists a folder, leaves out files by what a filter asks of their names, takes the
newest edition where a source publishes editions, and cuts what remains into ranges of
bytes.  A range is read where it is planned to; a line belongs to the range in which it
begins, so ranges need not know each other, and a lost task is read again.

Folders are opened by Arrow's file systems, on the executors as on the driver: local
disks, HDFS, S3 and what else ``pyarrow.fs`` knows.  Paths that only Spark's own readers
can open are for ``spark.read.json`` and ``text``, whose frames the functions of
``landed`` take as well.
"""

from __future__ import annotations

import io
import json
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

from tidemark.operators.routing import REGIONS

#: Bytes of a partition of lines.
SPLIT_BYTES = 32 << 20
#: Lines that are parsed at once.
LINES = 5_000
_TESTS = {
    ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge, ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le, ds.StringStartsWith: str.startswith,
}


def register(spark: SparkSession) -> None:
    """Make both sources known to the session, and let it hand filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedReports)
    spark.dataSource.register(DegreeDayFiles)


@dataclass
class Landed:
    """A file of the folder; ``day`` is the first run of eight digits in its name that is a date."""

    name: str
    path: str
    size: int
    day: date | None


@dataclass
class Range(ds.InputPartition):
    """Bytes ``[start, end)`` of a file; the whole of it where ``whole``."""

    file: Landed
    start: int
    end: int
    whole: bool = False


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def _day(name: str) -> date | None:
    for digits in re.findall(r"(?<!\d)\d{8}(?!\d)", name):
        try:
            return datetime.strptime(digits, "%Y%m%d").date()
        except ValueError:
            pass
    return None


def listed(path: str) -> list[Landed]:
    """Files of a folder by name; hidden ones, and those that a writer has not finished, begin with a dot or an underscore."""
    system, folder = _opened(path)
    found = [f for f in system.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name[0] not in "._"]
    return sorted((Landed(f.base_name, f.path, f.size, _day(f.base_name)) for f in found), key=lambda f: f.name)


def _cut(files: list[Landed], split: int, whole: bool) -> list[Range]:
    if whole:
        return [Range(f, 0, f.size, True) for f in files]
    return [Range(f, i, min(i + split, f.size), False) for f in files for i in range(0, f.size, split)]


def _lines(path: str, part: Range) -> Iterator[tuple[int, bytes]]:
    """(place of its first byte, line) of the lines that begin in a range."""
    system, _ = _opened(path)
    with system.open_input_file(part.file.path) as raw, io.BufferedReader(raw, 1 << 20) as f:
        at = part.start
        if at:  # what stands before the first line's end is of the range before, unless a line begins here
            f.seek(at - 1)
            at += len(f.readline()) - 1
        while at < part.end:
            line = f.readline()
            if not line:
                return
            yield at, line.rstrip(b"\r\n")
            at += len(line)


class _Filters:
    """The filters on some columns, as tests of values; others are left to Spark."""

    def __init__(self, columns: tuple[str, ...]):
        self.columns, self.tests = columns, []

    def take(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column not in self.columns:
                yield f
            elif isinstance(f, ds.In):
                self.tests.append((column, None, tuple(f.value)))
            elif type(f) in _TESTS:
                self.tests.append((column, _TESTS[type(f)], f.value))
            elif isinstance(f, ds.IsNotNull):
                self.tests.append((column, operator.is_not, None))
            else:
                yield f

    def passes(self, column: str, value) -> bool:
        """Whether a value meets the filters of its column; null meets none."""
        mine = [(op, x) for c, op, x in self.tests if c == column]
        return not mine or value is not None and all(value in x if op is None else op(value, x) for op, x in mine)

    def mask(self, column: str, values: np.ndarray) -> np.ndarray:
        """As ``passes``, of instants (UTC, microseconds) that are never null."""
        out = np.ones(values.shape, bool)
        for c, op, x in self.tests:
            if c == column and op is not operator.is_not:
                out &= np.isin(values, [_instant(v) for v in x]) if op is None else op(values, _instant(x))
        return out


def _instant(t: datetime) -> np.datetime64:
    return np.datetime64(t.astimezone(UTC).replace(tzinfo=None) if t.tzinfo else t, "us")


class _Source(ds.DataSource):
    def _options(self) -> tuple[str, int]:
        if not self.options.get("path"):
            raise ValueError(f"{self.name()}: a folder is needed")
        split = int(self.options.get("splitBytes", SPLIT_BYTES))
        if split < 1:
            raise ValueError(f"{self.name()}: splitBytes must be positive")
        return self.options["path"], split


# -- paged reports --------------------------------------------------------------


class LandedReports(_Source):
    """Rows of paged reports: (file, day, page, pos, m), m from a field's name to its text.

    ``page`` is the place in the file at which its envelope begins, ``pos`` the row's place
    in that.  A file has an envelope in each line, or is one as a whole (``multiLine``).
    Option ``columns`` names the fields that are kept, comma-separated.  Filters on ``file``
    and ``day`` (of the file's name; null without one) leave out files while planning.
    As a stream, files are taken in order of their names; one that turns up before a file
    that was read already is an error, as it would be lost.  Null and empty pages have no
    rows; rows without a list of fields, and rows of another length, are errors.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_reports"

    def schema(self) -> str:
        return "file string, day date, page bigint, pos int, m map<string, string>"

    def reader(self, schema) -> _ReportReader:
        return _ReportReader(*self._options(), self.options)

    def streamReader(self, schema) -> _ReportStream:
        return _ReportStream(*self._options(), self.options)


class _Pages:
    """Reads ranges of report files; shared by batch and stream."""

    def __init__(self, path: str, split: int, options):
        self.path, self.split = path, split
        self.whole = str(options.get("multiLine", "false")).lower() == "true"
        self.kept = {c.strip() for c in options.get("columns", "").split(",") if c.strip()}

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where nothing is planned
            return
        if partition.whole:
            system, _ = _opened(self.path)
            with system.open_input_stream(partition.file.path) as f:
                pages = iter([(0, f.read())])
        else:
            pages = _lines(self.path, partition)
        for at, text in pages:
            if text.strip():
                yield from self._rows(partition.file, at, json.loads(text) or {})

    def _rows(self, file: Landed, at: int, page: dict) -> Iterator[pa.RecordBatch]:
        rows, fields = page.get("data") or [], [f["name"] for f in page.get("fields") or []]
        if not rows:
            return
        if not fields or any(len(r) != len(fields) for r in rows):
            raise ValueError(f"{file.name}: report rows without fields, or of another length than these")
        places = [i for i, name in enumerate(fields) if not self.kept or name in self.kept]
        n, k = len(rows), len(places)
        keys = pa.array([fields[i] for i in places] * n, pa.string())
        items = pa.array([_text(r[i]) for r in rows for i in places], pa.string())
        maps = pa.MapArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), keys, items)
        yield pa.RecordBatch.from_arrays(
            [pa.array([file.name] * n), pa.array([file.day] * n, pa.date32()), pa.array(np.full(n, at)), pa.array(np.arange(n, dtype=np.int32)), maps],
            ["file", "day", "page", "pos", "m"],
        )


def _text(value) -> str | None:
    """A JSON value as Spark's reader gives it for a column of strings."""
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)


class _ReportReader(_Pages, ds.DataSourceReader):
    def __init__(self, path: str, split: int, options):
        super().__init__(path, split, options)
        self.filters = _Filters(("file", "day"))

    def pushFilters(self, filters):
        return list(self.filters.take(filters))

    def partitions(self) -> list[Range]:
        files = [f for f in listed(self.path) if self.filters.passes("file", f.name) and self.filters.passes("day", f.day)]
        return _cut(files, self.split, self.whole)


class _ReportStream(_Pages, ds.DataSourceStreamReader):
    """Offsets are the last file's name and the number of files up to it."""

    def initialOffset(self) -> dict:
        return {"file": "", "n": 0}

    def latestOffset(self) -> dict:
        files = listed(self.path)
        return {"file": files[-1].name, "n": len(files)} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files = listed(self.path)
        for offset in (start, end):
            if sum(f.name <= offset["file"] for f in files) > offset["n"]:
                raise ValueError(f"{self.path}: a file was landed before {offset['file']}, which is read already")
        return _cut([f for f in files if start["file"] < f.name <= end["file"]], self.split, self.whole)


# -- degree days ----------------------------------------------------------------


class DegreeDayFiles(_Source):
    """(instrument_id, valid_time, value) of the newest edition in a folder of fixed-width text.

    An edition is a file, or a folder of files once its writer has left ``_SUCCESS`` in it.
    Options: ``kind`` of the edition's name (``…<kind>-v1.0.0-YYYYMMDD…``) and ``element``, two
    digits.  The edition is chosen while planning; filters on both keys are met before rows
    are made.  As a stream, each trigger gives the whole of the newest edition, if it is
    newer than the one before; editions in between are superseded.  No edition, no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "degree_day_files"

    def schema(self) -> str:
        return "instrument_id string, valid_time timestamp, value double"

    def reader(self, schema) -> _DegreeReader:
        return _DegreeReader(*self._options(), self.options)

    def streamReader(self, schema) -> _DegreeStream:
        return _DegreeStream(*self._options(), self.options)


class _Editions:
    def __init__(self, path: str, split: int, options):
        self.path, self.split = path, split
        self.kind, self.element = options["kind"], options["element"].encode()
        self.filters = _Filters(("instrument_id", "valid_time"))

    def newest(self) -> str:
        """Name of the newest edition, as ``landed.newest_file`` chooses it; empty without one."""
        system, folder = _opened(self.path)
        dated = []
        for f in system.get_file_info(fs.FileSelector(folder)):
            m = re.search(rf"{self.kind}-v[0-9.]+-(\d{{8}})", f.base_name)
            if m and (f.is_file or system.get_file_info(f"{f.path}/_SUCCESS").is_file):
                dated.append((m[1], f.base_name))
        return max(dated, default=("", ""))[1]

    def ranges(self, edition: str) -> list[Range]:
        if not edition:
            return []
        system, folder = _opened(self.path)
        f = system.get_file_info(f"{folder}/{edition}")
        files = [Landed(f.base_name, f.path, f.size, None)] if f.is_file else listed(f"{self.path.rstrip('/')}/{edition}")
        return _cut(files, self.split, False)

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        regions = {code.encode(): f"NOAA.HDD.{name}" for code, name in REGIONS.items()}
        regions = {code: name for code, name in regions.items() if self.filters.passes("instrument_id", name)}
        some: list[bytes] = []
        for _, line in _lines(self.path, partition):
            if len(line) >= 10 and line[:3] in regions and line[4:6] == self.element:
                some.append(line)
                if len(some) == LINES:
                    yield self._rows(some, regions)
                    some = []
        if some:
            yield self._rows(some, regions)

    def _rows(self, lines: list[bytes], regions: dict[bytes, str]) -> pa.RecordBatch:
        """Twelve months of each line; a blank field has no row, -9999 and what is no number are null."""
        years = np.array([int(x[6:10]) for x in lines]) - 1970
        times = ((years * 12)[:, None] + np.arange(12)).ravel().astype("datetime64[M]").astype("datetime64[us]")
        fields = pa.array([x[10 + 7 * m : 17 + 7 * m].strip(b" ").decode() for x in lines for m in range(12)])
        right = pc.match_substring_regex(fields, r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
        values = pc.utf8_trim_whitespace(pc.if_else(right, fields, pa.scalar(None, pa.string()))).cast(pa.float64())
        values = pc.if_else(pc.equal(values, -9999.0), pa.scalar(None, pa.float64()), values)
        kept = pa.array(pc.not_equal(fields, "").to_numpy(False) & self.filters.mask("valid_time", times))
        ids = pa.array([regions[x[:3]] for x in lines for _ in range(12)])
        return pa.RecordBatch.from_arrays([ids, pa.array(times, pa.timestamp("us", "UTC")), values], ["instrument_id", "valid_time", "value"]).filter(kept)


class _DegreeReader(_Editions, ds.DataSourceReader):
    def pushFilters(self, filters):
        return list(self.filters.take(filters))

    def partitions(self) -> list[Range]:
        return self.ranges(self.newest())


class _DegreeStream(_Editions, ds.DataSourceStreamReader):
    """Offsets are editions, by name."""

    def initialOffset(self) -> dict:
        return {"edition": ""}

    def latestOffset(self) -> dict:
        return {"edition": self.newest()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.ranges(end["edition"]) if end != start else []
