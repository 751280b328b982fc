"""Every query against DuckDB on the smallest tables; those without SQL must run and return rows."""

import math
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans import catalogue

FOLDER = Path(entry.SMOKE_FOLDER)
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")

# the optional package has tests of its own
QUERIES = {key: plan for key, plan in entry.queries().items() if key in catalogue.QUERIES}
SQL = {key: sql for key, sql in entry.oracle_sql().items() if key in catalogue.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 6) + 0.0
        return value

    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


# joins of all pairs, and rows that leave the JVM
SLOW_NODES = {"CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["select_filter"](spark, str(FOLDER)))
    assert "GreaterThan(o_totalprice,250000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_orders_are_counted_before_they_are_joined(spark):
    plan = plan_of(QUERIES["rate_report"](spark, str(FOLDER)))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line and "o_custkey" in line]
    counts = [i for i, line in enumerate(plan.splitlines()) if "partial_count(1)" in line]
    # the plan is printed from the result down to the scans
    assert joins and counts and max(joins) < min(counts)


def test_text_terms_are_counted_without_a_shuffle_of_pairs(spark):
    plan = plan_of(QUERIES["term_freq"](spark, str(FOLDER)))
    assert "hashpartitioning" not in plan and "HashAggregate" not in plan


def test_every_sql_has_its_query():
    assert SQL.keys() <= QUERIES.keys()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    result = QUERIES[key](spark, str(FOLDER))
    rows = [tuple(r) for r in result.collect()]
    assert rows
    assert not SLOW_NODES & set(re.findall(r"\w+", plan_of(result)))
    if key in SQL:
        cursor = duck.execute(SQL[key])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(result.columns)
        assert comparable(rows, result.columns) == comparable(cursor.fetchall(), columns)
