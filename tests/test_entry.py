"""The driver contract, and every oracle on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


def test_contract():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 6) + 0.0)
    return None if value is None else str(value)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    want = Counter(tuple(plain(v) for v in r) for r in con.sql(f"SELECT {listed} FROM ({entry.oracle_sql()[name]})").fetchall())
    assert got == want
