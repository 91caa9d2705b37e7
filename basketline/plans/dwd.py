"""Cleaned, denormalised order facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import iso_weekday, month_key, whole_minutes
from ..functions.rules import valid_order
from ..operators.lookups import looked_up
from ..operators.windows import first_rows
from ..schemas import conform


def build_dwd_orders(orders: DataFrame, users: DataFrame) -> DataFrame:
    """One row per order with user attributes, time parts and flags.

    Orders of unknown users stay, with NULL attributes. The first order of a user is the
    earliest of any status, ties broken by ``order_id``; orders without a user count as
    one user.

    The wide order rows move once, to meet one small row per user (attributes and first
    order). In that join a user with very many orders is split by adaptive execution,
    which it cannot do for a window.
    """
    first = first_rows(orders, ["user_id"], ["create_time", "order_id"], ["order_id"])
    profile = users.select("user_id", "username", "age", "city", F.col("level").alias("user_level"))
    per_user = (
        first.withColumnRenamed("order_id", "__first_order")
        .join(looked_up(profile, users.count()), "user_id", "left")
        .withColumnRenamed("user_id", "__user")
    )
    created, paid = F.col("create_time"), F.col("pay_time")
    facts = orders.join(per_user, F.col("user_id").eqNullSafe(F.col("__user")), "left").withColumns({
        "order_date": F.to_date(created),
        "order_hour": F.hour(created),
        "order_weekday": iso_weekday(F.to_date(created)),
        "is_valid_order": valid_order(F.col("status")),
        "is_first_order": F.when(F.col("order_id") == F.col("__first_order"), 1).otherwise(0),
        "pay_latency_min": whole_minutes(created, paid),
    })
    return conform(facts, "dwd_orders")


def build_dwd_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order and product, with product and order attributes.

    Items without an order are dropped; items of unknown products stay, with NULL
    attributes. Few products may be broadcast, as the planner decides; many meet the items
    in a sort-merge join, see :func:`looked_up`.
    """
    order_part = orders.select(
        "order_id", "user_id", F.col("create_time").alias("order_time"),
        valid_order(F.col("status")).alias("is_valid_order"),
    )
    product_part = products.select("product_id", "product_name", "category", "sub_category", "brand")
    facts = items.join(order_part, "order_id").join(looked_up(product_part, products.count()), "product_id", "left")
    return conform(facts, "dwd_order_items")


def with_order_month(facts: DataFrame, time_column: str) -> DataFrame:
    """Add the partition column of a stored fact table."""
    return facts.withColumn("order_month", month_key(F.to_date(time_column)))


def dwd_orders_metrics() -> list[Column]:
    """Total, valid and first orders, as aggregates."""
    return [F.count(F.lit(1)).alias("total"), F.sum("is_valid_order").alias("valid"), F.sum("is_first_order").alias("first")]


def dwd_items_metrics() -> list[Column]:
    """Total and valid items, as aggregates."""
    return [F.count(F.lit(1)).alias("total"), F.sum("is_valid_order").alias("valid")]


def dwd_orders_stats(dwd_orders: DataFrame) -> DataFrame:
    """Total, valid and first orders of a finished build."""
    return dwd_orders.agg(*dwd_orders_metrics())


def dwd_items_stats(dwd_order_items: DataFrame) -> DataFrame:
    return dwd_order_items.agg(*dwd_items_metrics())
