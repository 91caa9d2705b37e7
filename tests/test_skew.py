"""One user, product or order holding a large part of the rows."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pytest
from micro import rows
from pyspark.sql import Window, functions as F

from basketline.operators import ranking
from basketline.plans import dwd_reports, dws
from basketline.plans.cleaning import clean_orders
from basketline.plans.dwd import build_dwd_order_items, build_dwd_orders
from basketline.schemas import conform
from basketline.sources import generate
from basketline.storage import materialize

AS_OF = "2026-03-01"


@contextmanager
def settings(spark, **conf):
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "48KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def shop(spark):
    """8,000 orders, a third of them by one user; a third of the items of one product."""
    ids = generate.numbers(spark, 8_000)
    orders = generate.gen_orders(ids, 3000, 300, as_of=AS_OF)
    hot_user = F.when(F.xxhash64("order_id") % 3 == 0, "U00000001").otherwise(F.col("user_id"))
    items = generate.gen_order_items(ids, 300).where("product_id <> 'P000001'")
    hot_product = F.when(
        (F.xxhash64("order_id") % 2 == 0) & (F.col("product_id") == F.min("product_id").over(Window.partitionBy("order_id"))), "P000001"
    ).otherwise(F.col("product_id"))
    return {
        "orders": conform(orders.withColumn("user_id", hot_user), "ods_orders").cache(),
        "items": conform(items.withColumn("product_id", hot_product), "ods_order_items").cache(),
        "users": generate.gen_users(generate.numbers(spark, 3000), as_of=AS_OF).cache(),
        "products": generate.gen_products(generate.numbers(spark, 300), as_of=AS_OF).cache(),
    }


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_joins_split_a_hot_key(spark, shop):
    with settings(spark, **SMALL_PARTITIONS):
        orders = build_dwd_orders(shop["orders"], shop["users"])
        assert "(skew=true)" in executed(orders)
        assert "(skew=true)" in executed(orders.hint("rebalance", "order_date"))
        items = build_dwd_order_items(shop["items"], shop["orders"], shop["products"])
        assert "(skew=true)" in executed(items)


def test_results_do_not_depend_on_how_keys_are_split(spark, shop):
    def tables():
        orders = build_dwd_orders(shop["orders"], shop["users"])
        items = build_dwd_order_items(shop["items"], shop["orders"], shop["products"])
        users = dws.build_user_summary(orders, items, shop["users"], AS_OF)
        return [rows(df) for df in (orders, items, users, dws.build_product_summary(items),
                                    dws.build_date_summary(orders, users))]

    plain = tables()
    with settings(spark, **SMALL_PARTITIONS):
        assert tables() == plain


def test_hot_user_reports_equal_plain_windows(spark, shop):
    facts = build_dwd_orders(shop["orders"], shop["users"]).cache()
    valid = facts.where("is_valid_order = 1").select("user_id", "order_id", "create_time", "total_amount")
    user = Window.partitionBy("user_id")
    ordered = user.orderBy("create_time", "order_id")
    previous = valid.select("*", F.lag("create_time").over(ordered).alias("at"), F.lag("total_amount").over(ordered).alias("paid"))
    expected = {
        "order_seq": valid.select("*", F.row_number().over(ordered)),
        "cumulative_spend": valid.select("*", F.sum("total_amount").over(user.orderBy("create_time")).cast("decimal(18,2)")),
        "prev_order": previous.select("*", F.datediff("create_time", "at")),
    }
    with settings(spark, **SMALL_PARTITIONS):
        for name, plain in expected.items():
            assert rows(getattr(dwd_reports, name)({"dwd_orders": facts})) == rows(plain), name
        seq = dwd_reports.order_seq({"dwd_orders": facts})
        assert "BroadcastHashJoin" not in executed(seq).split("Window")[0]


def test_copies_of_one_order_are_cut_before_the_shuffle(spark, shop):
    order = shop["orders"].where("order_id = 'O000000002' and status is not null")
    copies = order.crossJoin(spark.range(20_000)).drop("id").repartition(8)
    cleaned = clean_orders(copies.unionByName(shop["orders"]))
    text = executed(cleaned)
    assert text.count("WindowGroupLimit") >= 2
    assert cleaned.count() == 8_000


def test_crowded_doubles_are_ranked_in_even_slices(spark):
    n = 1_000_000
    value = F.pmod(F.xxhash64("id"), F.lit(2**40)) / F.lit(2.0**40) * 0.001
    df = spark.range(n).select("id", value.alias("v")).withColumn("v", F.when(F.col("id") % 1000 > 0, F.col("v")))
    df = materialize(df, "doubles")
    hist = df.where("v is not null").groupBy("v").count()
    sizes = [r["count"] for r in ranking.range_slices(hist, ["v"], "part").groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)

    values = np.array([r.v for r in df.where("v is not null").orderBy("id").select("v").toLocalIterator()])
    found = ranking.exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.999}).first()
    assert np.allclose(found, np.quantile(values, [0.25, 0.5, 0.999]), rtol=1e-12)
    ordered = np.sort(values)
    ranks = ranking.rank_within(df.withColumn("g", F.lit(1)), ["g"], "v", "rank").where("id % 997 = 0").collect()
    for r in ranks:
        assert r["rank"] == (len(values) + 1 if r.v is None else len(values) - np.searchsorted(ordered, r.v, "right") + 1)
    ranks = ranking.rank_within(df.withColumn("g", F.lit(1)), ["g"], "v", "rank", dense=True, descending=False).where("id % 997 = 0")
    distinct = np.unique(values)
    for r in ranks.collect():
        assert r["rank"] == (len(distinct) + 1 if r.v is None else np.searchsorted(distinct, r.v) + 1)
