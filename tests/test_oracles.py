"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from adloom.checks.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in sorted(DATA.glob("*.parquet"))]

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return connection


def comparable(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    values = [
        tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in data
    ]
    return sorted(names), sorted(values, key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, str(DATA))
    expected = duck.sql(entry_points.oracle_sql()[name])
    found = comparable(df.columns, [tuple(r) for r in df.collect()])
    assert found == comparable(expected.columns, expected.fetchall())


def test_no_python_in_any_plan(spark):
    for name, query in QUERIES.items():
        if not name.startswith(("load_", "pipeline_", "mart_", "stg_shard")):
            plan = query(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in plan and "Pandas" not in plan, name
            assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
