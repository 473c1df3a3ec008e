"""Every registered query against its SQL check on the smallest tables, and the shape of its plan."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
import workload
from workload.profile_queries import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")

QUERIES, ORACLES = workload.QUERIES, workload.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def canonical(rows):
    def cell(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(map(cell, r)) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    columns = sorted(df.columns)
    got = canonical(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == canonical(tuple(r[i] for i in order) for r in result.fetchall())


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
