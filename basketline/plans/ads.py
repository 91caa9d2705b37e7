"""The application layer: one row of headline figures per day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.cohorts import retention


def ads_daily_kpis(t: Mapping[str, DataFrame]) -> DataFrame:
    """Daily active users, sales, and the retention of the users who started that day.

    Both sides have one row per day.
    """
    cohorts = retention(t["dwd_orders"].where("is_valid_order = 1"), "user_id", "order_date")
    cohorts = cohorts.select(
        "first_date", "new_users", "d1_retention_pct", "d7_retention_pct", "d30_retention_pct"
    ).withColumnsRenamed({"first_date": "date", "new_users": "cohort_users"})
    days = t["dws_date_summary"].select("date", "dau", "new_users", "valid_orders", "total_amount")
    return days.withColumnRenamed("total_amount", "gmv").join(cohorts, "date", "left").orderBy("date")
