"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill import queries as core


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "" if v is None else str(v)


def rows_of(rows, order):
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


core.load()


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_sql(spark, data, duck, name):
    df = core.QUERIES[name](spark, data)
    cur = duck.execute(core.SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    assert rows_of(df.collect(), [df.columns.index(c) for c in cols]) == rows_of(cur.fetchall(), [names.index(c) for c in cols])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_runs(spark, data, name):
    df = core.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_evaluation_replays_every_answer(spark, data):
    from corpusmill.plans import evaluation
    from corpusmill.queries.common import full_rows

    got = {r["level"]: r["n"] for r in core.QUERIES["evaluation_run"](spark, data).collect()}
    rows = full_rows(spark, data)
    said = evaluation.replay(rows.selectExpr("row_id", "element_at(messages, -1).content as t"), "row_id", "t")
    scores = evaluation.evaluate(rows.selectExpr("row_id", "reference", "meta.level"), said, "row_id", "reference", "level")[0]
    assert sum(got.values()) == scores.filter("parsed and level is not null").count() > 0
    # a row without any prediction counts in the whole, not in its level
    gold = spark.createDataFrame([(1, [("a", "C", 1.0)], "easy"), (2, [("a", "C", 1.0)], "easy")], "id int, reference array<struct<subtype:string,smiles:string,weight:double>>, level string")
    said = evaluation.replay(spark.createDataFrame([(1, '[{"subtype": "a", "smiles": "C"}]')], "id int, t string"), "id", "t")
    _, total, levels = evaluation.evaluate(gold, said, "id", "reference", "level")
    assert total.first()["avg_s_total"] == 0.5 and [(r["level"], r["n"], r["avg_s_total"]) for r in levels.filter("level = 'easy'").collect()] == [("easy", 1, 1.0)]
