"""Every query with SQL gives SQL's rows at the smallest scale; plans push down what they should."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
SQL = entry.oracle_sql()


def normal(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.queries()))
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    got = df.collect()
    if name not in SQL:
        assert df.columns
        return
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in got]) == rows_of(rel.columns, rel.fetchall())


def test_contract(spark, data):
    assert set(SQL) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert importlib.util.find_spec("millrace") is not None


def test_filters_and_columns_reach_the_scan(spark, data):
    plan = entry.queries()["pushed_predicates"](spark, data)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "notes.bench.example" in plan.split("PushedFilters")[-1]
    assert "text" not in plan.split("ReadSchema")[-1]


def test_group_limit_below_the_shuffle(spark, data):
    plan = entry.queries()["pair_topn"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_core_does_not_import_the_llm_part():
    for p in (ROOT / "millrace").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "millrace").parts:
            assert "millrace.llm" not in p.read_text(), p
