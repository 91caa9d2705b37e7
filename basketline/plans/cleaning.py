"""Cleaning of raw orders before they become facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import SUSPICIOUS_AMOUNT
from ..operators.windows import top_n_per_group


def _latest(orders: DataFrame) -> DataFrame:
    """One row per ``order_id``: the latest, ties broken by all other columns.

    Copies are dropped before the shuffle as well, so an order repeated very often does
    not overload a task.
    """
    rest = [F.col(c).desc_nulls_last() for c in orders.columns if c not in ("order_id", "create_time")]
    return top_n_per_group(orders, ["order_id"], [F.col("create_time").desc_nulls_last(), *rest])


def _reason(max_amount: float):
    user, amount = F.col("user_id"), F.col("total_amount")
    return (
        F.when(user.isNull(), "null_user").when(amount.isNull(), "null_amount")
        .when(amount <= 0, "invalid_amount").when(amount > max_amount, "suspicious_amount")
    )


def clean_orders(orders: DataFrame, max_amount: float = SUSPICIOUS_AMOUNT) -> DataFrame:
    """Deduplicated orders with a key, a user and a plausible amount."""
    keyed = _latest(orders.where("order_id IS NOT NULL"))
    return keyed.where(_reason(max_amount).isNull())


def quarantined_orders(orders: DataFrame, max_amount: float = SUSPICIOUS_AMOUNT) -> DataFrame:
    """The deduplicated orders that :func:`clean_orders` leaves out, with the reason; without a key, every row."""
    keyed = _latest(orders.where("order_id IS NOT NULL"))
    unnamed = orders.where("order_id IS NULL").withColumn("reason", F.lit("null_order_id"))
    return keyed.withColumn("reason", _reason(max_amount)).where("reason IS NOT NULL").unionByName(unnamed)
