"""NaN as a missing value, failure cases in errors, unknown symbols, parts of a stream."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gate, routing
from tidemark.operators.store import Store
from tidemark.sources import landed

AT = datetime(2024, 1, 10, tzinfo=UTC)


def test_shapes_drop_nan(spark):
    raw = spark.sql("select 1 as _order, from_json('{\"response\":{\"data\":[{\"period\":\"2024-01-05\",\"value\":\"NaN\"},{\"period\":\"2024-01-05\",\"value\":\"2\"}]}}', '" + landed.RECORDS + "') as j").select("_order", "j.*")
    assert [r.value for r in landed.weekly(raw, "X").collect()] == [2.0]


def test_gate_takes_nan_for_null(spark):
    rows = [("a", datetime(2024, 1, 9), float("nan")), ("a", datetime(2024, 1, 8), 3.0), ("a", datetime(2024, 1, 7), -1.0)]
    df = spark.createDataFrame(rows, "instrument_id string, valid_time timestamp, value double")
    got = {(r.check, r.column): r.n_failed for r in gate.failures(df, gate.GATES["EIA_GAS_STORAGE"]).collect()}
    assert got == {("not_null", "value"): 1, ("band", "value"): 1}
    nullable = gate.Gate("own", (gate.Field("value", "double", True, 0, None),))
    assert [r.check for r in gate.failures(df.where("not value < 0"), nullable).collect()] == []
    assert [r.value for r in gate.validate(df.where("not value < 0"), nullable).orderBy("valid_time").collect()] == [3.0, None]


def test_errors_show_cases(spark):
    rows = [("a", "2024-01-09", "7"), ("a", "2024-01-09", "-5"), ("b", "2024-01-08", "x"), (None, "2024-01-08", "1")]
    df = spark.createDataFrame(rows, "instrument_id string, valid_time string, value string")
    with pytest.raises(gate.QualityGateError) as e:
        gate.validate(df, gate.GATES["EIA_GAS_STORAGE"])
    cases = {(f["check"], f["column"]): f["cases"] for f in e.value.failures}
    assert cases[("band", "value")] == ["-5"] and cases[("dtype", "value")] == ["x"] and cases[("not_null", "instrument_id")] == ["null"]
    assert cases[("unique", "instrument_id,valid_time")][0].startswith("a,2024-01-09") and "-5" in str(e.value)


def lmp(spark, rows):
    df = spark.createDataFrame(rows, "instrument_id string, valid_time timestamp, price double")
    return routing.routed(df.withColumn("settlement_point", F.lit("P")))


def test_parts_of_a_stream_add_up_and_replays_do_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    put = lambda batch, *rows: store.commit(lmp(spark, rows), as_of=AT, fetched_at=AT, source="s", batch=batch)
    one, two = ("ERCOT.SPP.A", datetime(2024, 1, 1), 1.0), ("ERCOT.SPP.A", datetime(2024, 1, 2), 2.0)
    assert put("b/0", one) and put("b/1", two, ("ERCOT.SPP.A", datetime(2024, 1, 1), 5.0))
    assert put("b/0", one) == [] and put("b/1", two) == []
    assert sorted((r.valid_time.day, r.price) for r in store.read("power.lmp").collect()) == [(1, 5.0), (2, 2.0)]
    assert store.commit(lmp(spark, [one]), as_of=AT, fetched_at=AT, source="s") == []  # no part of a stream: known already


def test_unknown_symbols_are_errors(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit(lmp(spark, [("ERCOT.SPP.A", datetime(2024, 1, 1), 1.0)]), as_of=AT, fetched_at=AT, source="s")
    assert store.series("power.lmp", "a").count() == 1
    assert store.series("power.lmp", "a", datetime(2023, 1, 1, tzinfo=UTC)).count() == 0
    with pytest.raises(KeyError):
        store.series("power.lmp", "b")
    with pytest.raises(Exception, match="unknown symbol"):
        routing.libraries_of_symbols(spark.createDataFrame([("nothing",)], "symbol string")).collect()
