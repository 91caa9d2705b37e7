"""Raw tables stored in buckets by order: nothing by order moves again, and keys are checked as before."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from micro import rows
from pyspark.sql import functions as F

from basketline.plans import dws, layers
from basketline.plans.dwd import build_dwd_order_items
from basketline.plans.layers import layers_of
from basketline.plans.quality import QualityError, dq_primary_key
from basketline.sources import starschema


def executed(df) -> str:
    df.collect()  # the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def shop(spark, path, lines=(), parts=()) -> str:
    """1,000 orders of four lines, and further lines (order, part) and parts (key, price)."""
    folder = str(path)
    more = spark.createDataFrame([*lines], "l_orderkey long, l_partkey long").select("*", F.lit(1.0), F.lit(5.0))
    spark.range(4_000).select(
        (F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"), F.lit(2.0).alias("l_quantity"),
        F.lit(10.0).alias("l_extendedprice")).union(more).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(40).select(
        F.col("id").alias("p_partkey"), (F.col("id") + 0.5).alias("p_retailprice"), F.concat(F.lit("n"), "id").alias("p_name"),
        F.lit("t").alias("p_type"), F.lit(7).alias("p_size"), F.lit("b").alias("p_brand"),
    ).union(spark.createDataFrame([*parts], "a long, b double").select("a", "b", F.lit("n"), F.lit("t"), F.lit(7), F.lit("b"))).write.parquet(
        f"{folder}/part.parquet")
    spark.range(1_001).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.fixture(params=["-1", "10m"])
def threshold(spark, request):
    """Joins by sorting, and as broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_items_meet_their_orders_and_are_checked_without_moving(spark, tmp_path, threshold):
    t = layers_of(spark, shop(spark, tmp_path, lines=[(0, 0), (0, 0)]))
    items, orders = t["ods_order_items"], t["ods_orders"]
    for name, key in (("ods_orders", ["order_id"]), ("ods_order_items", ["order_id", "product_id"])):
        assert "hashpartitioning" not in executed(dq_primary_key(t[name], name, key, name in t.buckets))
    facts = build_dwd_order_items(items, orders, t["ods_products"])
    assert "hashpartitioning(order_id" not in executed(facts)
    assert facts.count() == 4_000 and rows(items.where("quantity <> 2"), "order_id", "quantity", "amount", "unit_price") == [
        ("O000000001", 4, 20, 0.5)]
    assert rows(items.where("unit_price IS NULL").agg(F.count_distinct("product_id"))) == [(10,)]
    assert rows(orders.groupBy("item_count").count()) == [(0, 1), (4, 1_000)]


def test_lines_move_once(spark, tmp_path, threshold):
    text = executed(starschema.order_items(spark, shop(spark, tmp_path)))
    assert text.split("== Initial Plan ==")[0].count("hashpartitioning(concat(O") == 1
    assert "hashpartitioning(order_id" not in text


@pytest.mark.parametrize("lines, parts", [([], [(7, 1.0)]), ([(None, 1)], []), ([(3, None)], [])])
def test_repeated_or_missing_keys_still_raise(spark, tmp_path, lines, parts):
    t = layers_of(spark, shop(spark, tmp_path, lines, parts))
    assert {r.item_count for r in t["ods_orders"].collect()} == {0, 4}  # of parts that are known and different
    with pytest.raises(QualityError):
        t["ods_order_items"]


def test_products_listed_twice_are_summed_by_their_attributes(spark, tmp_path):
    t = layers_of(spark, shop(spark, tmp_path, parts=[(7, 1.0)]))
    for name in ("ods_products", "ods_order_items"):
        with pytest.raises(QualityError):
            t[name]
    assert t.unique("ods_products") is None
    assert rows(t["dws_product_summary"]) == rows(dws.build_product_summary(t["dwd_order_items"]))


def test_product_attributes_do_not_move_with_every_item(spark, tmp_path):
    t = layers_of(spark, shop(spark, tmp_path))
    items, products = t["dwd_order_items"], t["ods_products"]
    assert t.unique("ods_products") is products
    assert rows(dws.build_product_summary(items, products)) == rows(dws.build_product_summary(items))
    assert rows(t["dws_product_summary"]) == rows(dws.build_product_summary(items))
    assert t["dws_product_summary"].where("product_name IS NULL").count() == 10
    moved = {}
    for name, given in (("with", products), ("without", None)):
        def per_buyer(rows_, *_, name=name):
            moved[name] = rows_.columns
            raise InterruptedError
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(dws, "spread_shares", per_buyer)
            patch.setattr(dws, "product_summary_of", per_buyer)
            with pytest.raises(InterruptedError):
                dws.build_product_summary(items, given)
    assert "product_name" in moved["without"] and "product_name" not in moved["with"]


@pytest.mark.parametrize("parts", [[], [(7, 1.0)]])
def test_products_of_orders_are_counted_without_a_distinct_where_keys_are_unique(spark, tmp_path, monkeypatch, parts):
    checked, told = [], []
    check, build = layers.dq_primary_key, starschema.orders
    monkeypatch.setattr(layers, "dq_primary_key", lambda df, name, *more: checked.append(name) or check(df, name, *more))
    monkeypatch.setattr(starschema, "orders", lambda s, f, items, unique: told.append(unique) or build(s, f, items, unique))
    folder = shop(spark, tmp_path, parts=parts)
    t = layers_of(spark, folder)
    assert {r.item_count for r in t["ods_orders"].collect()} == {0, 4}
    if parts:
        with pytest.raises(QualityError):
            t["ods_order_items"]
    else:
        t["ods_order_items"]
    assert told == [not parts] and checked.count("ods_order_items") == 1
    plan = executed(build(spark, folder, t.unchecked("ods_order_items"), told[0]))
    assert any("product_id" in keys for keys in re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)) == bool(parts)
