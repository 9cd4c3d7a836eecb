"""Bars with prices of zero, below it, NaN or none: queries against their SQL."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest

from tidemark import queries as core

T0 = datetime(2024, 1, 1)
#: Symbol: prices of an hour in order of time, by hour; the other hours have prices above zero.
ODD = {
    "low": {70: (0.0, 5.0, 3.0)},
    "close": {70: (4.0, 5.0, 0.0)},
    "open": {70: (0.0, 5.0, 4.0)},
    "flat": {70: (0.0, 0.0, 0.0)},
    "below": {70: (3.0, -2.0, 4.0)},
    "nan": {70: (3.0, math.nan, 4.0)},
    "none": {70: (None, None, None)},
    "negative mean": {h: (1.0 + h % 3, 1.0 + h % 3, 9.0) for h in range(70, 110)},
    "plain": {},
}


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    rows = []
    for s, own in ODD.items():
        for h in range(130):
            base = 20.0 + (h * 7919 + len(s) * 31) % 23
            prices = own.get(h, (base, base - 3.0 - h % 4, base + 2.0 + h % 5, base + h % 2))
            rows += [(T0 + timedelta(hours=h, minutes=10 * i), s, v) for i, v in enumerate(prices)]
    con = duckdb.connect()
    con.execute("CREATE TABLE e (event_id BIGINT, ts TIMESTAMP, event_type VARCHAR, value DOUBLE)")
    con.executemany("INSERT INTO e VALUES (?, ?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    con.execute(f"COPY e TO '{d}/events.parquet'")
    return str(d)


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v.replace(tzinfo=None) if isinstance(v, datetime) else v


@pytest.mark.parametrize("name", ["H02_parkinson", "H03_garman_klass", "H04_metrics", "H07_yang_zhang", "H08_vol_averages", "G03_price_reversals"])
def test_odd_prices_as_in_sql(spark, odd, name):
    df = core.QUERIES[name](spark, odd)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{odd}/events.parquet'")
    result = con.execute(core.SQL[name])
    names = [c[0] for c in result.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall()), key=str)
    assert got == want
