"""Reports on the raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import VALID_STATUSES
from ..functions.money import money, ratio
from ..operators.lookups import looked_up
from ..operators.ranking import top_k
from ..operators.summaries import share_of_total, table_census

Tables = Mapping[str, DataFrame]


def ods_table_census(t: Tables) -> DataFrame:
    return table_census({n: t[n] for n in ("ods_users", "ods_products", "ods_orders", "ods_order_items")})


def status_share(t: Tables) -> DataFrame:
    return share_of_total(t["ods_orders"], "status")


def valid_order_amounts(t: Tables) -> DataFrame:
    amount = F.col("total_amount")
    return t["ods_orders"].where(F.col("status").isin(*VALID_STATUSES)).agg(
        F.count(F.lit(1)).alias("paid_orders"),
        money(F.sum(amount)).alias("gmv"),
        ratio(F.sum(amount), F.count(amount)).alias("avg_order_value"),
        F.min(amount).alias("min_amt"),
        F.max(amount).alias("max_amt"),
    )


def city_top10(t: Tables, k: int = 10) -> DataFrame:
    by_city = t["ods_users"].groupBy("city").agg(F.count(F.lit(1)).alias("user_count"))
    return top_k(by_city, [F.desc("user_count"), F.asc("city")], k)


def category_gmv_ods(t: Tables) -> DataFrame:
    """Orders and sales per category over all order states, by a join.

    Items are reduced to (category, order) before counting, so distinct orders become a
    plain count.
    """
    products = t["ods_products"]
    per_order = (
        t["ods_order_items"].join(looked_up(products.select("product_id", "category"), products.count()), "product_id")
        .groupBy("category", "order_id").agg(F.sum("amount").alias("amount"))
    )
    return per_order.groupBy("category").agg(
        F.count("order_id").alias("order_count"), money(F.sum("amount")).alias("gmv")
    ).orderBy(F.desc("gmv"), "category")


def order_time_span(t: Tables) -> DataFrame:
    first, last = F.min("create_time"), F.max("create_time")
    return t["ods_orders"].agg(
        first.alias("earliest"), last.alias("latest"), F.datediff(last, first).alias("day_span")
    )


def orders_with_users(t: Tables) -> DataFrame:
    """The join that the denormalised order fact saves (compare ``join_vs_denorm``)."""
    users = t["ods_users"]
    return t["ods_orders"].join(looked_up(users.select("user_id", "username"), users.count()), "user_id", "left").select(
        "order_id", "username", "total_amount"
    )
