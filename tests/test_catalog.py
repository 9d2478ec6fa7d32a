"""A cross-section of the registered queries against their SQL, and the plans of the large joins."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from tests.conftest import plan

SF = "/root/testdata/sf0.001"
SOME = (
    "community", "taxa", "time_consistent", "cpue_by_lineage_year", "sample_counts", "effort_month",
    "fish_sample_match", "region_means", "gear_proportion", "lm_by_group", "lab_sheets", "filter_not_in",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", entry.queries() if os.environ.get("ALL_QUERIES") else SOME)
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name in entry.oracle_sql():
        want = con.sql(entry.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["fish_sample_match", "distance_join", "point_in_region", "community", "effort_grid", "standardize"])
def test_no_products_in_plans(spark, name):
    executed = plan(entry.queries()[name](spark, SF)).split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in executed and "NestedLoopJoin" not in executed


def test_filters_and_columns_reach_the_scan(spark):
    executed = plan(entry.queries()["filter_year"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in executed
