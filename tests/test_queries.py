"""Registered queries against their DuckDB counterparts on the smallest tables."""

import glob
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from recordlake.plans.oracle import ORACLE
from recordlake.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
# No pairing of everything with everything; Python only works on Arrow batches.
NOT_WANTED = ["CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "InPandas"]
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return round(value, 9) if isinstance(value, float) else value


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 39 and rows[0].pct == 100.0


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in NOT_WANTED if bad in plan]
    columns = sorted(got.columns)
    cursor = duck.execute(ORACLE[name])
    listed = [c[0] for c in cursor.description]
    assert sorted(listed) == columns
    places = [listed.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in places) for r in cursor.fetchall()]
    assert in_order(tuple(plain(r[c]) for c in columns) for r in got.collect()) == in_order(want)
