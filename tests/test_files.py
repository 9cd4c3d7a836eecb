"""Landed files as data sources, in batch and as streams."""

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, landed


@pytest.fixture(scope="module", autouse=True)
def sources(spark):
    files.register(spark)


def page(rows, fields=("deliveryDate", "deliveryHour", "settlementPoint")):
    return json.dumps({"data": rows, "fields": [{"name": f} for f in fields]})


def land(folder, name, *pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(pages) + "\n")


def rows_of(df):
    return sorted((r.file, r.page, r.pos, tuple(sorted(r.m.items()))) for r in df.collect())


def test_any_split_reads_each_line_once(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "a-20240105.json", *(page([["2024-01-05", str(i), "é" * i], [None, 7, True]]) for i in range(5)), "", "null", page([]))
    land(folder, "b-20240106.json", page([["2024-01-06", "1", "LZ_WEST"]]))
    (folder / "_SUCCESS").touch()
    (folder / ".b.crc").write_text("x")
    whole = spark.read.format("landed_reports").load(str(folder))
    want = rows_of(whole)
    assert len(want) == 11 and {r[0] for r in want} == {"a-20240105.json", "b-20240106.json"}
    assert dict(want[1][3]) == {"deliveryDate": None, "deliveryHour": "7", "settlementPoint": "true"}
    for split in (1, 7, 64, 131, 1000):
        df = spark.read.format("landed_reports").option("splitBytes", split).load(f"file://{folder}")
        assert rows_of(df) == want
    # a line that begins at the start of a range is that range's
    at = len((folder / "a-20240105.json").read_bytes().split(b"\n")[0]) + 1
    assert rows_of(spark.read.format("landed_reports").option("splitBytes", at).load(str(folder))) == want
    few = spark.read.format("landed_reports").option("columns", "settlementPoint").load(str(folder))
    assert [r[3] for r in rows_of(few)] == [tuple(x for x in r[3] if x[0] == "settlementPoint") for r in want]


def test_as_json_reader(spark, tmp_path):
    fields = ("deliveryDate", "deliveryHour", "deliveryInterval", "settlementPoint", "settlementPointPrice", "DSTFlag")
    folder = tmp_path / "in"
    for k in range(3):
        pages = [page([["2024-01-05", str(h), "1", "HB_NORTH", f"{100 * k + 10 * p + h}", "false"] for h in (1, 2, k + 3)], fields) for p in range(2)]
        land(folder, f"prices-{k}.json", *pages)
    got = landed.real_time_prices(spark.read.format("landed_reports").option("splitBytes", 200).load(str(folder)))
    want = landed.real_time_prices(spark.read.schema(landed.REPORT).json(str(folder)))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 5


def test_filters_leave_out_files(spark, tmp_path):
    folder = tmp_path / "in"
    for day in range(1, 10):
        land(folder, f"r-2024010{day}.json", page([[f"2024-01-0{day}", "1", "HB_NORTH"]]))
    land(folder, "r-undated.json", page([["x", "1", "HB_NORTH"]]))
    df = spark.read.format("landed_reports").load(str(folder))

    def read(where):
        some = df.where(where)
        return sorted({r.file[2:-5] for r in some.collect()}), some.rdd.getNumPartitions()

    assert read(F.col("day") >= date(2024, 1, 8)) == (["20240108", "20240109"], 2)
    assert read((F.col("day") < date(2024, 1, 3)) & (F.col("pos") == 0)) == (["20240101", "20240102"], 2)
    assert read(F.col("file").isin("r-20240104.json", "none")) == (["20240104"], 1)
    assert read(F.col("file").startswith("r-u")) == (["undated"], 1)
    assert read(F.col("day").isNotNull())[1] == 9
    assert read(F.col("day").isNull())[0] == ["undated"]


def test_whole_files_and_faults(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    source = spark.read.format("landed_reports").option("multiLine", "true")
    assert source.load(str(folder)).count() == 0
    (folder / "a.json").write_text(json.dumps(json.loads(page([["2024-01-05", "1", "HB_NORTH"]])), indent=2))
    assert [r[:3] for r in rows_of(source.load(str(folder)))] == [("a.json", 0, 0)]
    for k, bad in enumerate((page([["x"]]), json.dumps({"data": [["x"]]}))):
        land(tmp_path / f"bad{k}", "a.json", bad)
        with pytest.raises(Exception, match="rows without fields"):
            spark.read.format("landed_reports").load(str(tmp_path / f"bad{k}")).count()
    with pytest.raises(Exception, match="a folder is needed"):
        spark.read.format("landed_reports").load().count()


def drained(spark, name, folder, out, state, **options):
    stream = spark.readStream.format(name).options(**options).load(str(folder))
    q = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(out))


def test_stream_takes_each_file_once_and_refuses_late_ones(spark, tmp_path):
    folder, where = tmp_path / "in", (tmp_path / "out", tmp_path / "state")
    land(folder, "b.json", page([["2024-01-05", "1", "HB_NORTH"]]))
    land(folder, "c.json", page([["2024-01-06", "1", "HB_NORTH"]]))
    assert drained(spark, "landed_reports", folder, *where).count() == 2
    land(folder, "d.json", page([["2024-01-07", "1", "HB_NORTH"], ["2024-01-07", "2", "HB_NORTH"]]))
    got = drained(spark, "landed_reports", folder, *where)
    assert sorted(r.file for r in got.collect()) == ["b.json", "c.json", "d.json", "d.json"]
    land(folder, "a.json", page([["2024-01-04", "1", "HB_NORTH"]]))
    land(folder, "e.json", page([["2024-01-08", "1", "HB_NORTH"]]))
    with pytest.raises(Exception, match="landed before d.json"):
        drained(spark, "landed_reports", folder, *where)


def line(code, element, year, first):
    return f"{code}0{element}{year}" + "".join(f"{v:7.1f}" for v in (first, -9999, *range(9))) + " " * 7


def test_newest_edition(spark, tmp_path):
    folder, where = tmp_path / "in", (tmp_path / "out", tmp_path / "state")
    folder.mkdir()
    options = {"kind": "hddcst", "element": "25"}
    read = lambda: spark.read.format("degree_day_files").options(splitBytes=50, **options).load(str(folder))
    assert read().count() == 0
    lines = [line(c, e, y, 1) for c in ("110", "041", "999") for e in ("25", "26") for y in (2023, 2024)] + ["short", ""]
    (folder / "climdiv-hddcst-v1.0.0-20240105").write_text("\n".join(lines))
    (folder / "climdiv-cddcst-v1.0.0-20240905").write_text("\n".join(lines))
    want = landed.degree_days(spark.createDataFrame([(x,) for x in lines], "value string"), "25", "value")
    assert sorted(read().collect(), key=str) == sorted(want.collect(), key=str) and want.count() == 44
    texas = read().where((F.col("instrument_id") == "NOAA.HDD.TEXAS") & (F.col("valid_time") >= F.lit(datetime(2024, 10, 1, tzinfo=UTC))))
    assert sorted(r.value for r in texas.collect()) == [7.0, 8.0]
    assert drained(spark, "degree_day_files", folder, *where, **options).count() == 44
    later = folder / "climdiv-hddcst-v1.0.0-20240205"
    land(later, "part-0", line("110", "25", 2024, 5))
    assert read().count() == 44  # its writer has not finished
    land(later, "part-1", line("041", "25", 2024, 6))
    (later / "_SUCCESS").touch()
    assert sorted(r.value for r in read().where("month(valid_time) = 1").collect()) == [5.0, 6.0]
    assert drained(spark, "degree_day_files", folder, *where, **options).count() == 44 + 22
    assert drained(spark, "degree_day_files", folder, *where, **options).count() == 44 + 22  # nothing newer
