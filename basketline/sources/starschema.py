"""The raw tables of the warehouse, mapped from a TPC-H-like star schema.

Every table is a lazy view: a query that reads two columns scans two columns, and joins
whose columns are not used disappear from the plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.rules import padded_id
from ..operators import lookups
from ..operators.slices import tasks_of
from ..schemas import conform
from ..storage import materialize

AS_OF = dt.date(2001, 8, 2)  # the day after the last order

# Market segment -> user level.
LEVEL_OF_SEGMENT = {"AUTOMOBILE": "Bronze", "BUILDING": "Silver", "FURNITURE": "Gold", "HOUSEHOLD": "Platinum"}


def source_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = (source_table(spark, folder, t) for t in ("customer", "nation"))
    key = F.col("c_custkey")
    level = F.lit("Diamond")
    for segment, name in LEVEL_OF_SEGMENT.items():
        level = F.when(F.col("c_mktsegment") == segment, name).otherwise(level)
    mapped = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        padded_id("U", key + 1, 8).alias("user_id"),
        F.col("c_name").alias("username"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        (16 + key % 52).cast("int").alias("age"),
        F.col("n_name").alias("city"),
        padded_id("1", key, 10).alias("phone"),
        level.alias("level"),
        F.date_sub(F.lit("1995-01-01").cast("date"), (key % 730).cast("int")).alias("register_date"),
    )
    return conform(mapped, "ods_users")


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    mapped = source_table(spark, folder, "part").select(
        padded_id("P", key + 1, 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat("p_type", F.lit("-"), (F.col("p_size") % 5).cast("string")).alias("sub_category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("brand"),
        (F.col("p_size") * 100).alias("stock"),
        F.date_sub(F.lit("1995-01-01").cast("date"), (key % 730).cast("int")).alias("on_shelf_date"),
    )
    return conform(mapped, "ods_products")


def order_tasks(spark: SparkSession, folder: str) -> int:
    """In how many partitions by order the orders and their items are left."""
    return tasks_of(source_table(spark, folder, "lineitem").count())


def orders(spark: SparkSession, folder: str, items: DataFrame | None = None, items_unique: bool = False) -> DataFrame:
    """The orders, partitioned by order. ``items`` is the table of :func:`order_items` where it is stored, in buckets by order.

    With ``items_unique``, no order has a product in two rows: its products are counted without a distinct.
    """
    items = order_items(spark, folder) if items is None else items
    products = F.count("product_id") if items_unique else F.count_distinct("product_id")
    counts = items.where("order_id IS NOT NULL").groupBy("order_id").agg(products.alias("n_items"))
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    low = F.col("o_orderpriority") == "5-LOW"
    status = (
        F.when(low & (state == "F"), "cancelled").when(low & (state == "O"), "refunded")
        .when(state == "P", "paid").when(state == "O", "shipped").otherwise("received")
    )
    # Order dates carry no time of day; the key supplies one.
    created = F.col("o_orderdate") + F.make_dt_interval(secs=((key * 7919) % 86400).cast("decimal(18,6)"))
    paid = F.col("create_time") + F.make_dt_interval(mins=(1 + key % 30).cast("int"))
    order_id = padded_id("O", key + 1, 9)
    source = source_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate")
    mapped = (
        source.repartition(order_tasks(spark, folder), order_id)
        .withColumns({"create_time": created, "status": status})
        .select(
            order_id.alias("order_id"),
            padded_id("U", F.col("o_custkey") + 1, 8).alias("user_id"),
            F.col("o_totalprice").alias("total_amount"),
            "status",
            "create_time",
            F.when(F.col("status") != "cancelled", paid).alias("pay_time"),
        )
        .join(counts, "order_id", "left")
        .withColumn("item_count", F.coalesce("n_items", F.lit(0)))
    )
    return conform(mapped, "ods_orders")


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, merged where an order lists a product twice, partitioned by order.

    Prices are looked up before the rows move to their orders. A part listed twice makes two rows of a key, one per copy.
    """
    copy = F.row_number().over(W.partitionBy("p_partkey").orderBy("p_retailprice")).alias("copy")
    part = source_table(spark, folder, "part")
    n_parts = part.count()
    part = part.where("p_partkey IS NOT NULL").select("p_partkey", "p_retailprice", copy)
    if n_parts > lookups.ROWS:  # read from a table, the lines of a frequent part are split over tasks
        part = lookups.looked_up(materialize(part, "part_prices"), n_parts)
    lines = source_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    lines = lines.join(part, lines.l_partkey == part.p_partkey, "left").drop("p_partkey")
    order_id = padded_id("O", F.col("l_orderkey") + 1, 9)
    moved = lines.repartition(order_tasks(spark, folder), order_id).withColumn("order_id", order_id).drop("l_orderkey")
    merged = moved.groupBy("order_id", "l_partkey", "copy").agg(
        F.sum("l_quantity").alias("quantity"),
        F.max("p_retailprice").alias("unit_price"),
        F.sum("price").alias("amount"),
    )
    return conform(merged.withColumn("product_id", padded_id("P", F.col("l_partkey") + 1, 6)), "ods_order_items")


ODS_BUILDERS = {
    "ods_users": users,
    "ods_products": products,
    "ods_orders": orders,
    "ods_order_items": order_items,
}
