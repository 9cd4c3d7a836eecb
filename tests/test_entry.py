"""The driver's contract: names, SQL, and life without the training-data operators."""

import math
import os
import shutil
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

from tidemark import queries as core

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_sql_has_its_query():
    assert set(core.SQL) <= set(core.QUERIES) and len(core.QUERIES) > 120


def test_without_the_training_data_operators(tmp_path):
    for name in ("tidemark", "__spark_entry__.py"):
        src = ROOT / name
        ignore = shutil.ignore_patterns("llm", "__pycache__")
        shutil.copytree(src, tmp_path / name, ignore=ignore) if src.is_dir() else shutil.copy(src, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_nothing_else_imports_them():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "tidemark.llm" not in path.read_text()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v.replace(tzinfo=None) if isinstance(v, datetime) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the given tables are not here")
@pytest.mark.parametrize(
    "name", ["D08_read_as_of", "G02_volume_anomalies", "H07_yang_zhang", "I05_roll_yield", "J10_as_of_join", "J04_article_symbols", "C09_row_failures", "A02_hourly_region", "A07_day_ahead_prices", "B01_route", "K11_cadence_gaps", "L04_volume_profile", "D05_late_backfill", "E11_fan_out"]
)
def test_queries_equal_their_sql(spark, name):
    df = core.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = con.execute(core.SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
