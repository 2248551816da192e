"""Every query with SQL against DuckDB on the smallest tables, where they are at hand."""

import datetime
import decimal
import math
import os

import pytest

DATA = os.environ.get("CHRONOFOLD_TESTDATA", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

import __spark_entry__ as entry  # noqa: E402

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in os.listdir(DATA):
        if t.endswith(".parquet"):
            p = f"{DATA}/{t}"
            c.execute(f"create view {t[:-8]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(x):
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (float, decimal.Decimal)):
        return "nan" if math.isnan(x) else repr(round(float(x), 6))
    return str(x)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(cols).collect())
    want = sorted(tuple(map(plain, r)) for r in con.sql(f"select {', '.join(f'"{c}"' for c in cols)} from ({entry.oracle_sql()[name]})").fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
