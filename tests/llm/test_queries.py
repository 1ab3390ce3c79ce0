"""The subpackage's queries with SQL give DuckDB's rows on the smallest tables; the others run."""

from pathlib import Path

import duckdb
import pytest

from corpusmill.llm.queries import QUERIES
from corpusmill.llm.sql import SQL
from tests.test_queries import rows_of


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    cur = duck.execute(SQL[name])
    names = [x[0] for x in cur.description]
    cols = sorted(names)
    assert cols == sorted(df.columns)
    assert rows_of(df.collect(), [df.columns.index(c) for c in cols]) == rows_of(cur.fetchall(), [names.index(c) for c in cols])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 0
