"""The bitemporal store, against fixed cases and a small model in memory."""

import random
from datetime import UTC, datetime, timedelta

import pytest

from tidemark.operators import gate, observe, routing
from tidemark.operators.store import Store

D = [datetime(2024, 1, d, tzinfo=UTC) for d in (1, 8, 15, 22)]
A = [datetime(2024, 1, d, 15, 30, tzinfo=UTC) for d in (16, 23, 30)]
ID, LIB = "EIA.NG.STORAGE.LOWER48", "fundamentals.eia"


def frame(spark, values, instrument=ID):
    rows = [(instrument, t, float(v)) for t, v in values.items()]
    return routing.routed(spark.createDataFrame(rows, "instrument_id string, valid_time timestamp, Close double"))


def put(store, spark, at, values, instrument=ID, **kw):
    return store.commit(frame(spark, values, instrument), as_of=at, fetched_at=kw.pop("fetched_at", at), source="t", **kw)


def got(store, at=None, library=LIB):
    return {r.valid_time.replace(tzinfo=UTC): r.Close for r in store.read(library, at).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_two_vintages(spark, store):
    put(store, spark, A[0], {D[0]: 10, D[1]: 11, D[2]: 12})
    put(store, spark, A[1], {D[1]: 21, D[2]: 22})
    assert got(store, A[0]) == {D[0]: 10, D[1]: 11, D[2]: 12}
    assert got(store, A[1]) == got(store) == {D[0]: 10, D[1]: 21, D[2]: 22}
    assert got(store, datetime(2023, 12, 31, tzinfo=UTC)) == {}


def test_same_as_of_and_same_content_do_nothing(spark, store):
    put(store, spark, A[0], {D[0]: 10, D[1]: 11})
    assert put(store, spark, A[0], {D[0]: 99}) == []
    assert put(store, spark, A[1], {D[0]: 10, D[1]: 11}) == []
    assert len(put(store, spark, A[2], {D[1]: 99})) == 1
    assert store.vintages().count() == 2 and got(store)[D[1]] == 99
    put(store, spark, A[2], {D[1]: 5}, force=True)
    assert got(store)[D[1]] == 5


def test_late_backfill_and_gaps(spark, store):
    put(store, spark, A[1], {D[1]: 2, D[2]: 3, D[3]: 4})
    put(store, spark, A[0], {D[0]: 1, D[1]: 1, D[2]: 1})
    assert got(store, A[0]) == {D[0]: 1, D[1]: 1, D[2]: 1}
    assert got(store, A[1]) == {D[1]: 2, D[2]: 3, D[3]: 4}
    put(store, spark, A[2], {D[1]: 100, D[3]: 300})
    assert got(store) == {D[1]: 100, D[2]: 3, D[3]: 300}


def test_replace_mode(spark, store):
    for at, v in ((A[0], {D[0]: 1, D[1]: 2}), (A[1], {D[1]: 3})):
        put(store, spark, at, v, "NOAA.HDD.TEXAS")
    assert got(store, A[0], "weather") == {D[0]: 1, D[1]: 2} and got(store, None, "weather") == {D[1]: 3}


def test_bars_keep_the_first_row(spark, store):
    put(store, spark, A[0], {D[0]: 1, D[2]: 3}, "CME.CL.FRONT")
    put(store, spark, A[1], {D[1]: 2, D[0]: 99}, "CME.CL.FRONT")
    assert got(store, None, "prices.intraday") == {D[0]: 1, D[1]: 2, D[2]: 3}
    assert got(store, A[0], "prices.intraday") == {D[0]: 1, D[2]: 3}


def test_provenance_by_row_and_orphans(spark, store):
    put(store, spark, A[0], {D[0]: 1, D[1]: 1, D[2]: 1}, reconstructed=True)
    put(store, spark, A[1], {D[1]: 2, D[2]: 2})
    flags = [r.vintage_reconstructed for r in store.read(LIB).orderBy("valid_time").collect()]
    assert flags == [True, False, False]
    frame(spark, {D[3]: 7}).drop("library", "mode").write.parquet(f"{store.root}/observations/{LIB}/commit_id=lost")
    assert D[3] not in got(store)
    assert store.remove_orphans(LIB) == ["lost"] and store.orphans(LIB).count() == 0


def test_compact_keeps_the_series(spark, store):
    put(store, spark, A[0], {D[0]: 10, D[1]: 11})
    put(store, spark, A[1], {D[1]: 21})
    before = got(store)
    store.compact(LIB, as_of=A[2], fetched_at=A[2])
    assert got(store) == before and got(store, A[0]) == {D[0]: 10, D[1]: 11}
    assert store.vintages().where("size(chain) = 1").count() == 2


@pytest.mark.parametrize("fold", [1, 2, 64])
def test_random_commits_against_a_model(spark, store, fold):
    """Merge commits in any order: a commit builds on the newest vintage before its own moment, as it was then."""
    store.fold = fold
    rng = random.Random(5)
    model = []  # (as_of, series)
    moments = [datetime(2024, 2, 1, tzinfo=UTC) + timedelta(days=i) for i in range(6)]
    for at in rng.sample(moments, 5):
        values = {D[i]: rng.randrange(100) for i in rng.sample(range(4), 2)}
        base = dict(max((m for m in model if m[0] < at), key=lambda m: m[0], default=(None, {}))[1])
        if all(base.get(k) == v for k, v in values.items()):
            continue
        put(store, spark, at, values)
        model.append((at, base | values))
    for at in moments:
        known = [m for m in model if m[0] <= at]
        assert got(store, at) == (max(known, key=lambda m: m[0])[1] if known else {})
    assert store.vintages().where(f"size(chain) > {fold}").count() == 0
    assert store.vintages().where("row_count > 2").count() == 0  # a commit's own rows


def test_unreadable_series(spark, store):
    put(store, spark, A[0], {D[0]: 10})
    (lost,) = put(store, spark, A[1], {D[0]: 11}, "EIA.PET.CRUDE.STOCKS")
    assert store.unreadable(LIB).count() == 0
    store.discard(LIB, lost)
    one = observe.readable(store.vintages(), store.unreadable(LIB)).first()
    assert (one.library, one.mode, one.n_symbols, one.unreadable) == (LIB, "bitemporal_merge", 1, 1)


def test_routes(spark):
    ids = ["EIA930.GEN_FUEL.ERCO", "ERCOT.SPP.HB_NORTH", "CME.CL.CLF26", "EIA930.D.", "NOPE.X"]
    df = spark.createDataFrame([(i,) for i in ids], "instrument_id string")
    rows = {r.instrument_id: (r.library, r.symbol, r.mode) for r in routing.route(df).collect()}
    assert rows["EIA930.GEN_FUEL.ERCO"] == ("power.generation_by_fuel", "erco", "degenerate")
    assert rows["ERCOT.SPP.HB_NORTH"] == ("power.lmp", "hb_north", "bitemporal_merge")
    assert rows["CME.CL.CLF26"] == ("prices.futures", "CL_CLF26", "bitemporal_merge")
    assert rows["EIA930.D."] == rows["NOPE.X"] == (None, None, None)
    assert {r.instrument_id for r in routing.unknown(df).collect()} == {"EIA930.D.", "NOPE.X"}
    with pytest.raises(Exception, match="unknown instrument_id"):
        routing.routed(df).collect()
    with pytest.raises(ValueError):
        routing.contracts_for(spark, "tulips")


NOW = datetime(2026, 6, 11, 15, 30, tzinfo=UTC)


def checks(df, name, now=NOW):
    return {(r.check, r.column) for r in gate.failures(df, gate.GATES[name], now).collect()}


@pytest.mark.parametrize(
    "name, row, change, failed",
    [
        ("EIA_GAS_STORAGE", {"value": 5.0}, {"value": -1.0}, ("band", "value")),
        ("EIA_PETROLEUM", {"value": 5.0}, {"value": None}, ("not_null", "value")),
        ("FRED_SPOT", {"value": 5.0}, {"valid_time": datetime(2026, 5, 1, tzinfo=UTC)}, ("age", "valid_time")),
        ("ERCOT_SPP", {"settlement_point": "HB_NORTH", "price": -20.0}, {"price": 9000.0}, ("band", "price")),
        ("ERCOT_LOAD", {"value": 50000.0}, {"value": 300000.0}, ("band", "value")),
        ("POWER_REGION", {"respondent": "ERCO", "value": -3.0}, {"value": 1e8}, ("band", "value")),
        ("POWER_GEN_BY_FUEL", {"respondent": "ERCO", "fuel_type": "NG", "value": None}, {"fuel_type": None}, ("not_null", "fuel_type")),
        ("NOAA_HDDCDD", {"hdd": -9999.0, "cdd": 3.0}, {"hdd": 10000.0}, ("band", "hdd")),
        ("OHLCV", {"Open": 1.0, "High": 1.0, "Low": 1.0, "Close": 1.0, "Volume": 1}, {"Close": -1.0}, ("band", "Close")),
    ],
)
def test_gates(spark, name, row, change, failed):
    types = {"value": "double", "price": "double", "hdd": "double", "cdd": "double", "Volume": "long"}
    row = {"instrument_id": "X", "valid_time": datetime(2026, 6, 10, tzinfo=UTC)} | row
    kinds = {"instrument_id": "string", "valid_time": "timestamp"}
    schema = ", ".join(f"{k} {kinds.get(k) or types.get(k) or ('double' if isinstance(v, float) else 'string')}" for k, v in row.items())
    make = lambda *rows: spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    assert checks(make(row), name) == set()
    assert failed in checks(make(row | change), name)
    assert any(c == "unique" for c, _ in checks(make(row, row), name))
    assert ("rows", "") in checks(make(row).where("false"), name)
    assert ("column", list(row)[-1]) in checks(make(row).drop(list(row)[-1]), name)
    with pytest.raises(gate.QualityGateError):
        gate.validate(make(row | change), gate.GATES[name], NOW)
