"""Every registered query beside its SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from moodloom.plans.catalog import QUERIES
from tests.conftest import physical_plan

SF_DIR = Path("/root/testdata/sf0.001")
ROWS_ONLY = {"classifier_comparison"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def stays_in_the_jvm(df):
    plan = physical_plan(df)
    bad = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin")
    return not any(name in plan for name in bad)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, str(SF_DIR))
    assert stays_in_the_jvm(df)
    run = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in run.description]
    assert sorted(columns) == sorted(df.columns)
    assert multiset(df.columns, df.collect()) == multiset(columns, run.fetchall())


def test_only_the_fitted_regression_lacks_sql():
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    df = queries()[name](spark, str(SF_DIR))
    assert stays_in_the_jvm(df) and df.count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["word", "count"] and df.count() == 10
