"""Every registered query of the engine against the SQL registered for it."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from detlake.plans import queries

DATA = os.environ.get("DETLAKE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(cols, data):
    norm = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(([norm(r[i]) for i in order] for r in data), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        name = f.removesuffix(".parquet")
        path = f"{DATA}/{f}" if os.path.isfile(f"{DATA}/{f}") else f"{DATA}/{f}/*.parquet"
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in queries.ORACLES:
        assert got and df.columns
        return
    want = con.execute(queries.ORACLES[name]).df()
    assert sorted(df.columns) == sorted(want.columns)
    data = [tuple(None if v is None or v != v else v for v in r) for r in want.astype(object).where(want.notna(), None).itertuples(index=False)]
    assert rows(df.columns, got) == rows(list(want.columns), data)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1
