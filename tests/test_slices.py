"""Rows that are grouped by keys few of them share: bounded tasks, same results."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from micro import rows
from pyspark.sql import functions as F

from basketline.operators import slices
from basketline.operators.summaries import having_duplicates
from basketline.plans import dwd_reports, dws, partials
from basketline.sources import starschema


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(slices, "ROWS", 100)


def sizes(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def moved_first(df, column: str, n: int) -> bool:
    """Whether the rows are moved by ``column`` into ``n`` tasks before they are grouped."""
    return any(column in line and f", {n})" in line for line in executed(df).splitlines() if "REPARTITION_BY_NUM" in line)


def test_tasks_stay_small_as_rows_grow(spark, small_tasks):
    for n in (1_000, 10_000):
        assert max(sizes(slices.spread(spark.range(n), ["id"]))) < 200


def test_a_frequent_key_is_dealt_over_tasks(spark, small_tasks):
    df = spark.range(8_000).select(F.lit("hot").alias("k"), "id")
    assert max(sizes(slices.spread_shares(df, ["k"], "id"))) < 8_000 * 0.5


def test_duplicates_are_moved_before_they_are_counted(spark, small_tasks):
    df = spark.range(5_000).select(F.when(F.col("id") > 10, F.col("id")).alias("a"), (F.col("id") % 2).alias("b")).union(
        spark.range(3).select(F.lit(77).cast("long"), F.lit(1).cast("long")))
    found = having_duplicates(df, ["a", "b"])
    assert moved_first(found, "a", 51)
    assert rows(found) == rows(spark.createDataFrame([(None, 0, 6), (None, 1, 5), (77, 1, 4)], "a long, b long, rows_count long"))


@pytest.fixture
def shop(spark, tmp_path):
    lines = spark.range(4_000).select(
        (F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"),
        F.lit(2.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"))
    twice = lines.where("l_orderkey < 3").union(spark.createDataFrame([(None, 1, 1.0, 5.0), (2, None, 1.0, 5.0)], lines.schema))
    lines.union(twice).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(50).select(F.col("id").alias("p_partkey"), F.lit(5.0).alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1_000).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("P").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_line_items_are_moved_before_they_are_merged(spark, shop, small_tasks):
    items, orders = starschema.order_items(spark, shop), starschema.orders(spark, shop)
    assert moved_first(items, "l_orderkey", 41) and moved_first(orders, "l_orderkey", 41)
    assert items.count() == 4_002 and items.where("quantity = 4").count() == 12
    assert {r.item_count for r in orders.collect()} == {4}


def sold(spark, n=3_000):
    """Items of 30 products, one of them with half of all rows."""
    product = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 30)
    return spark.range(n).select(
        F.concat(F.lit("O"), F.col("id")).alias("order_id"), F.concat(F.lit("P"), product).alias("product_id"),
        F.lit(2).alias("quantity"), F.lit(3).cast("decimal(10,2)").alias("unit_price"), F.lit(6).cast("decimal(12,2)").alias("amount"),
        F.lit("n").alias("product_name"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"), F.lit("b").alias("brand"),
        F.concat(F.lit("U"), F.col("id") % 7).alias("user_id"), F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("order_time"),
        F.lit(1).alias("is_valid_order"))


def test_sums_per_product_are_moved_first(spark, small_tasks):
    items = sold(spark)
    top = dwd_reports.top_products({"dwd_order_items": items})
    assert moved_first(top, "product_id", 30)
    best = top.collect()[0]
    assert (best.product_id, best.total_qty, best.total_sales) == ("P0", 3_000, decimal.Decimal("9000.00"))
    summary = {r.product_id: r for r in dws.build_product_summary(items).collect()}
    assert (summary["P0"].total_orders, summary["P0"].total_users, summary["P0"].category_rank) == (1_500, 7, 1)


def test_merged_partials_are_moved_first(spark, small_tasks):
    day = F.lit(dt.date(2000, 1, 1))
    days = spark.range(1_000).select(
        day.alias("order_date"), F.concat(F.lit("U"), F.col("id") % 900).alias("user_id"), F.lit(1).cast("long").alias("orders"),
        F.lit(1).cast("long").alias("valid"), F.lit(2).cast("decimal(38,2)").alias("amount"), F.lit(1).cast("long").alias("priced"))
    found = partials.merged("day_users", days)
    assert moved_first(found, "user_id", 10)
    assert found.count() == 900 and found.where("orders = 2").count() == 100
