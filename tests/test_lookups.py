"""Tables that compress to less than the broadcast limit but have many rows stay out of the driver."""

from __future__ import annotations

import datetime as dt

import pytest
from micro import rows
from pyspark.sql import functions as F
from test_buckets import shop

from basketline.operators import distinct_sets, lookups
from basketline.plans import dws, ods_reports, partials, quality
from basketline.plans.dwd import build_dwd_order_items, build_dwd_orders
from basketline.schemas import conform
from basketline.sources import generate, starschema

AS_OF, MANY = "2026-03-01", 120_000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """300 orders of 200 users and 50 products in tables of 120,000 users and products, stored in a few megabytes."""
    folder = str(tmp_path_factory.mktemp("wide"))
    ids, day = generate.numbers(spark, 300), F.lit(dt.date(2025, 1, 1))
    n = F.col("id") + 1
    users = spark.range(MANY).select(
        F.concat(F.lit("U"), F.lpad(n.cast("string"), 8, "0")).alias("user_id"), F.concat(F.lit("u"), n).alias("username"), F.lit("F").alias("gender"),
        F.lit(30).alias("age"), F.lit("X").alias("city"), F.lit("11").alias("phone"), F.lit("Gold").alias("level"), day.alias("register_date"))
    products = spark.range(MANY).select(
        F.concat(F.lit("P"), F.lpad(n.cast("string"), 6, "0")).alias("product_id"), F.lit("p").alias("product_name"), F.lit("A").alias("category"),
        F.lit("A-1").alias("sub_category"), F.lit(3).alias("price"), F.lit("b").alias("brand"), F.lit(5).alias("stock"), day.alias("on_shelf_date"))
    found = {"users": conform(users, "ods_users"), "products": conform(products, "ods_products"),
             "orders": generate.gen_orders(ids, 200, 50, as_of=AS_OF), "items": generate.gen_order_items(ids, 50)}
    for name, df in found.items():
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in found}


@pytest.fixture
def planned(spark):
    """Plans as sizes of files decide them, before anything is measured."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", old)


def facts(t):
    return build_dwd_orders(t["orders"], t["users"]), build_dwd_order_items(t["items"], t["orders"], t["products"])


def test_few_rows_are_left_to_the_planner(spark, planned):
    keys = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert "BroadcastHashJoin" in planned(keys.join(lookups.looked_up(keys.distinct()), "k"))
    assert "BroadcastHashJoin" not in planned(keys.join(lookups.looked_up(keys.distinct(), lookups.ROWS + 1), "k"))


def test_facts_broadcast_neither_many_users_nor_many_products(tables, planned):
    orders, items = facts(tables)
    assert "BroadcastHashJoin [user_id" not in planned(orders)
    assert "BroadcastHashJoin [product_id" not in planned(items)
    assert orders.count() == 300 and orders.where("username IS NULL").count() == 0
    assert items.count() == tables["items"].count() and items.where("category = 'A'").count() == items.count()


def test_summaries_broadcast_neither_many_users_nor_many_products(spark, tables, planned):
    orders, items = facts(tables)
    everyone = tables["users"].select("user_id", F.lit(1).alias("is_repurchase"))
    assert "BroadcastHashJoin [user_id" not in planned(dws.build_date_summary(orders, everyone))
    given = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dws, "materialize", lambda df, name: given.append(df) or df)
        summary = dws.build_product_summary(items, tables["products"])
    assert "BroadcastHashJoin [product_id" not in planned(given[0])
    assert rows(summary) == rows(dws.build_product_summary(items))


def test_many_products_are_ranked_without_a_broadcast(spark, tables, planned):
    per_buyer = tables["products"].select(
        "product_id", *dws.PRODUCT_ATTRIBUTES, F.lit("U1").alias("user_id"), F.lit(3).cast("decimal(10,2)").alias("price"),
        F.crc32("product_id").alias("quantity"), F.lit(1).cast("long").alias("counted"), F.lit(1).cast("long").alias("orders"),
        F.lit(3).cast("decimal(20,2)").alias("amount"), F.lit(dt.date(2025, 1, 1)).alias("first_day"), F.lit(dt.date(2025, 1, 1)).alias("last_day"))
    ranked = dws.product_summary_of(per_buyer)
    assert "BroadcastHashJoin" not in planned(ranked)
    assert ranked.agg(F.count_distinct("category_rank"), F.max("category_rank")).first()[1] <= MANY == ranked.count()


def test_reports_and_checks_broadcast_neither_many_users_nor_many_products(spark, tables, planned):
    t = {f"ods_{name}": df for name, df in [*tables.items(), ("order_items", tables["items"])]}
    numbers = tables["users"].select("user_id", F.monotonically_increasing_id().alias("number"))
    found = [
        quality.dq_orphans(tables["orders"], tables["items"].where("product_id > 'P000010'"), tables["users"], tables["products"]),
        ods_reports.orders_with_users(t), ods_reports.category_gmv_ods(t),
        distinct_sets.with_numbers(tables["orders"], numbers, "user_id"),
    ]
    for df in found:
        assert "BroadcastHashJoin [user_id" not in planned(df) and "BroadcastHashJoin [product_id" not in planned(df)
    assert [r.observed for r in found[0].orderBy("check").collect()] == [0, 0, 0]
    assert found[1].where("username IS NOT NULL").count() == found[3].where("number IS NOT NULL").count() == 300
    given = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(partials, "materialize", lambda df, name: given.append(df) or df)
        partials.partials_of(tables["orders"], tables["items"], tables["products"])
    assert "BroadcastHashJoin [product_id" not in planned(given[-1])


@pytest.mark.parametrize("limit", [0, lookups.ROWS])
def test_prices_of_many_parts_are_not_broadcast(spark, tmp_path, planned, monkeypatch, limit):
    folder = shop(spark, tmp_path, lines=[(0, 0), (None, 7), (3, None)], parts=[(7, 1.0), (None, 2.0)])
    few = rows(starschema.order_items(spark, folder))
    assert len(few) == 4_000 + 80 + 3
    monkeypatch.setattr(lookups, "ROWS", limit)
    items = starschema.order_items(spark, folder)
    assert ("BroadcastHashJoin [l_partkey" in planned(items)) == (limit > 0)
    assert rows(items) == few


def test_lines_of_a_frequent_part_are_split(spark, tmp_path, monkeypatch):
    from test_skew import SMALL_PARTITIONS, executed, settings

    folder = shop(spark, tmp_path, lines=[(n, 7) for n in range(2_000, 20_000)])
    few = rows(starschema.order_items(spark, folder))
    monkeypatch.setattr(lookups, "ROWS", 0)
    with settings(spark, **SMALL_PARTITIONS):
        items = starschema.order_items(spark, folder)
        assert "(skew=true)" in executed(items)
        assert rows(items) == few
