"""Every registered query against its SQL, and the plans of the large ones."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry_module
from basketline import oracle
from basketline.plans.layers import layers_of
from basketline.plans.registry import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql_without_python_or_cross_joins(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert compare.difference(df, duck, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


ROW_LEVEL = ["dwd_orders", "dwd_order_items", "dws_user_base", "dws_user_summary", "dws_product_summary", "order_seq",
             "cumulative_spend", "prev_order", "brand_rank", "first_orders", "clean_orders"]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_level_results_never_pass_through_one_task(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, FOLDER))


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(QUERIES["status_share"](spark, FOLDER))
    assert "l_partkey" not in text and "o_totalprice" not in text and "Join" not in text


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["daily_new_users"](spark, FOLDER))
    assert "EqualTo(is_valid_order,1)" in text


def test_period_reports_skip_other_months(spark):
    assert "PartitionFilters: [isnotnull(order_month" in plan(QUERIES["active_30d"](spark, FOLDER))


def test_raw_reports_scan_stored_tables(spark):
    text = plan(QUERIES["category_gmv_ods"](spark, FOLDER))
    assert "l_orderkey" not in text and "l_partkey" not in text


def test_queries_of_the_entry_include_these(spark):
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


def test_layers_are_stored_once(spark):
    first, second = layers_of(spark, FOLDER), layers_of(spark, FOLDER)
    assert first is second and first["dwd_orders"].inputFiles() == second["dwd_orders"].inputFiles()
