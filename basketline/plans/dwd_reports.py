"""Reports on the order facts.

Reports that only preview a large result in the shop's console take ``limit``; without it
they return every row, unsorted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import (
    FREQUENCY_ORDERS, LEVEL_NAMES, MONETARY_AMOUNTS, RECENCY_DAYS, REPURCHASE_BINS, REPURCHASE_BINS_SHORT,
    REPURCHASE_REST, REPURCHASE_REST_SHORT, VALID_STATUSES,
)
from ..functions.dates import as_of_date, month_key
from ..functions.money import money, percent, ratio
from ..functions.rules import bucketize, bucketize_at_least
from ..operators import cohorts
from ..operators.ranking import rank_within, top_k
from ..operators.slices import SHARE, spread_shares
from ..operators.summaries import table_census
from ..operators.windows import running_sum, sequence_number, with_previous

Tables = Mapping[str, DataFrame]


def _valid(t: Tables, name: str = "dwd_orders") -> DataFrame:
    return t[name].where("is_valid_order = 1")


def _preview(df: DataFrame, limit: int | None, *order: str | Column) -> DataFrame:
    return df if limit is None else df.orderBy(*order).limit(limit)


def order_seq(t: Tables, limit: int | None = None) -> DataFrame:
    orders = _valid(t).select("user_id", "order_id", "create_time", "total_amount")
    numbered = sequence_number(orders, ["user_id"], ["create_time", "order_id"], "order_seq")
    return _preview(numbered, limit, "user_id", "create_time", "order_id")


def cumulative_spend(t: Tables, user_id: str | None = None) -> DataFrame:
    """Running spend of every user, or of one; orders of one moment share the total."""
    orders = _valid(t).select("user_id", "order_id", "create_time", "total_amount")
    if user_id is not None:
        orders = orders.where(F.col("user_id") == user_id)
    summed = running_sum(orders, ["user_id"], "create_time", "total_amount", "cumulative_spent")
    return summed.withColumn("cumulative_spent", money(F.col("cumulative_spent")))


def prev_order(t: Tables, limit: int | None = None) -> DataFrame:
    orders = _valid(t).select("user_id", "order_id", "create_time", "total_amount")
    previous = with_previous(
        orders, ["user_id"], ["create_time", "order_id"],
        {"create_time": "prev_order_time", "total_amount": "prev_amount"},
    )
    previous = previous.withColumn("days_to_prev", F.datediff("create_time", "prev_order_time"))
    return _preview(previous, limit, "user_id", "create_time", "order_id")


def first_orders(t: Tables, limit: int | None = None) -> DataFrame:
    return _preview(t["dwd_orders"].drop("order_month").where("is_first_order = 1"), limit, "order_id")


def user_repurchase_cycle(t: Tables, limit: int | None = None) -> DataFrame:
    """Mean days from one valid order to the next, per user with at least two.

    The steps add up to last day minus first day, so no order has to be paired with the
    one before it.
    """
    per_user = _valid(t).groupBy("user_id").agg(
        F.datediff(F.max("order_date"), F.min("order_date")).alias("days"),
        (F.count("create_time") - 1).alias("repurchase_count"),
    ).where("repurchase_count > 0")
    cycle = per_user.select(
        "user_id",
        ratio(F.col("days"), F.col("repurchase_count"), 4).alias("avg_days_to_repurchase"),
        "repurchase_count",
    )
    return _preview(cycle, limit, "avg_days_to_repurchase", "user_id")


def rfm_levels(t: Tables, as_of: dt.date | str | None = None, limit: int | None = None) -> DataFrame:
    """Recency, frequency, amount per user with fixed thresholds."""
    high, middle, low = LEVEL_NAMES
    per_user = _valid(t).groupBy("user_id").agg(
        F.datediff(as_of_date(as_of), F.max("order_date")).alias("r"),
        F.count(F.lit(1)).alias("f"),
        money(F.sum("total_amount")).alias("m"),
    )
    steps = lambda bounds: list(zip(bounds, (high, middle)))
    levels = per_user.select(
        "*",
        bucketize(F.col("r"), steps(RECENCY_DAYS), low).alias("r_level"),
        bucketize_at_least(F.col("f"), steps(FREQUENCY_ORDERS), low).alias("f_level"),
        bucketize_at_least(F.col("m"), steps(MONETARY_AMOUNTS), low).alias("m_level"),
    )
    return _preview(levels, limit, "user_id")


def brand_rank(t: Tables, limit: int | None = None) -> DataFrame:
    sales = _valid(t, "dwd_order_items").groupBy("category", "brand").agg(
        money(F.sum("amount")).alias("total_sales")
    )
    ranked = rank_within(sales, ["category"], "total_sales", "brand_rank_in_category", dense=True)
    return _preview(ranked, limit, "category", "brand_rank_in_category", "brand")


def monthly_gmv(t: Tables) -> DataFrame:
    """Orders, users and sales per month; ``order_id`` must be unique.

    Reduced to (month, user) first, so distinct users become a plain count.
    """
    per_user = _valid(t).groupBy(month_key(F.col("order_date")).alias("month"), "user_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("priced"),
    )
    return per_user.groupBy("month").agg(
        F.sum("orders").alias("order_count"),
        F.count("user_id").alias("active_users"),
        money(F.sum("amount")).alias("gmv"),
        ratio(F.sum("amount"), F.sum("priced")).alias("avg_order_value"),
    ).orderBy("month")


def active_30d(t: Tables, as_of: dt.date | str | None = None, window_days: int = 30, min_orders: int = 2) -> DataFrame:
    """Users with at least ``min_orders`` valid orders in the last ``window_days`` days."""
    since = F.date_sub(as_of_date(as_of), window_days)
    recent = _valid(t).where(F.col("order_date") >= since)
    if "order_month" in recent.columns:  # facts that were not taken from stored layers lack it
        recent = recent.where(F.col("order_month") >= month_key(since))
    per_user = recent.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_orders)
    return per_user.agg(F.count(F.lit(1)).alias("active_user_count"))


def top_products(t: Tables, k: int = 10) -> DataFrame:
    product = ["product_id", "product_name", "category", "brand"]
    sold = _valid(t, "dwd_order_items").select(*product, "order_id", F.col("quantity").cast("bigint").alias("quantity"), "amount")
    shares = spread_shares(sold, ["product_id"], "order_id").groupBy(*product, SHARE).agg(
        F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"))
    sales = shares.groupBy(*product).agg(F.sum("quantity").alias("total_qty"), money(F.sum("amount")).alias("total_sales"))
    return top_k(sales, [F.desc("total_sales"), F.asc("product_id")], k)


def daily_new_users(t: Tables) -> DataFrame:
    """Users whose first order is valid, per day. A user has one first order, so rows are users."""
    first = _valid(t).where("is_first_order = 1")
    return first.groupBy("order_date").agg(F.count("user_id").alias("new_user_count")).orderBy("order_date")


def retention_d1_d7_d30(t: Tables) -> DataFrame:
    return cohorts.retention(_valid(t), "user_id", "order_date")


def retention_d7(t: Tables) -> DataFrame:
    seven = cohorts.retention(_valid(t), "user_id", "order_date", {"d7": (1, 7)})
    return seven.select("first_date", "new_users", "d7_retention_pct")


def funnel(t: Tables, known_only: bool = True) -> DataFrame:
    """Distinct users who placed, paid for, were sent, received an order.

    Orders in an unknown state count as placed only without ``known_only``.
    """
    status, orders = F.col("status"), t["dwd_orders"]
    if known_only:
        orders = orders.where((F.col("is_valid_order") == 1) | status.isin("cancelled", "refunded"))
    return cohorts.funnel(orders, "user_id", {
        "step1_total_users": F.lit(True),
        "step2_paid": status.isin(*VALID_STATUSES),
        "step3_shipped": status.isin("shipped", "received"),
        "step4_received": status == "received",
    })


def repurchase_rate(t: Tables) -> DataFrame:
    per_user = _valid(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    totals = per_user.agg(
        F.count(F.lit(1)).alias("total_buyers"), F.count_if(F.col("n") >= 2).alias("repurchase_buyers")
    )
    rate = percent(F.col("repurchase_buyers"), F.col("total_buyers"))
    return totals.withColumn("repurchase_rate_pct", rate)


def repurchase_interval_dist(t: Tables) -> DataFrame:
    return cohorts.interval_histogram(_valid(t), "user_id", "order_date", REPURCHASE_BINS, REPURCHASE_REST)


def repurchase_interval_dist4(t: Tables) -> DataFrame:
    return cohorts.interval_histogram(
        _valid(t), "user_id", "order_date", REPURCHASE_BINS_SHORT, REPURCHASE_REST_SHORT, share=False
    )


def order_streaks(t: Tables, min_days: int = 3) -> DataFrame:
    return cohorts.streaks(_valid(t), "user_id", "order_date", min_days)


def new_vs_returning(t: Tables) -> DataFrame:
    """Buyers and sales per month, by whether the order is the user's first."""
    first = F.col("is_first_order") == 1
    later = F.col("is_first_order") == 0
    part = lambda condition: F.sum(F.when(condition, F.col("total_amount")).otherwise(0))
    flag = lambda condition: F.max(F.when(condition, 1).otherwise(0))
    per_user = _valid(t).groupBy(month_key(F.col("order_date")).alias("month"), "user_id").agg(
        flag(first).alias("new"), flag(later).alias("back"),
        part(first).alias("new_gmv"), part(later).alias("back_gmv"),
    )
    users = lambda name: F.sum(F.when(F.col("user_id").isNotNull(), F.col(name)).otherwise(0))
    return per_user.groupBy("month").agg(
        users("new").alias("new_buyers"),
        users("back").alias("returning_buyers"),
        money(F.sum("new_gmv")).alias("new_buyer_gmv"),
        money(F.sum("back_gmv")).alias("returning_buyer_gmv"),
    ).orderBy("month")


def dwd_table_census(t: Tables) -> DataFrame:
    flags = ("dwd_orders", "dwd_order_items")
    return table_census(
        {n: t[n] for n in flags},
        {"valid_cnt": {n: F.sum("is_valid_order") for n in flags},
         "first_order_cnt": {"dwd_orders": F.sum("is_first_order")}},
        count_name="total",
    )


def valid_vs_invalid(t: Tables) -> DataFrame:
    return t["dwd_orders"].groupBy("is_valid_order").agg(
        F.count(F.lit(1)).alias("order_count"), money(F.sum("total_amount")).alias("total_amount")
    ).orderBy("is_valid_order")


def first_order_city(t: Tables, k: int = 10) -> DataFrame:
    by_city = _valid(t).where("is_first_order = 1").groupBy("city").agg(
        F.count(F.lit(1)).alias("first_order_user_count"),
        ratio(F.sum("total_amount"), F.count("total_amount")).alias("avg_first_order_amount"),
    )
    return top_k(by_city, [F.desc("first_order_user_count"), F.asc("city")], k)


def category_gmv_dwd(t: Tables) -> DataFrame:
    per_order = _valid(t, "dwd_order_items").groupBy("category", "order_id").agg(F.sum("amount").alias("amount"))
    return per_order.groupBy("category").agg(
        F.count("order_id").alias("order_count"), money(F.sum("amount")).alias("gmv")
    ).orderBy(F.desc("gmv"), "category")


def hourly_orders(t: Tables) -> DataFrame:
    return _valid(t).groupBy("order_hour").agg(F.count(F.lit(1)).alias("order_count")).orderBy("order_hour")


def level_spend(t: Tables) -> DataFrame:
    per_user = _valid(t).groupBy("user_level", "user_id").agg(
        F.sum("total_amount").alias("amount"), F.count("total_amount").alias("priced")
    )
    return per_user.groupBy("user_level").agg(
        F.count("user_id").alias("user_count"),
        ratio(F.sum("amount"), F.sum("priced")).alias("avg_order_amount"),
    ).orderBy("user_level")


def join_vs_denorm(t: Tables) -> DataFrame:
    """Order, user name and amount straight from the fact table, without a join."""
    return t["dwd_orders"].select("order_id", "username", "total_amount")
