"""Queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from detlake.llm import queries
from tests.test_entry import DATA, rows


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.QUERIES[name](spark, DATA)
    want = con.execute(queries.ORACLES[name]).df()
    assert sorted(df.columns) == sorted(want.columns)
    data = [tuple(None if v is None or v != v else v for v in r) for r in want.astype(object).where(want.notna(), None).itertuples(index=False)]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(want.columns), data)
