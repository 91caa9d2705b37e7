"""Profiles of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.money import ratio
from ..operators.ranking import exact_quantiles, top_k
from ..operators.summaries import value_counts


def profile_orders(orders: DataFrame) -> DataFrame:
    """Row count, mean, extremes and time range in one pass."""
    amount = F.col("total_amount")
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        ratio(F.sum(amount), F.count(amount)).alias("avg_amount"),
        F.max(amount).alias("max_amount"),
        F.min(amount).alias("min_amount"),
        F.min("create_time").alias("earliest"),
        F.max("create_time").alias("latest"),
    )


def value_counts_status(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "status")


def value_counts_category(products: DataFrame) -> DataFrame:
    return value_counts(products, "category")


def city_top5(users: DataFrame, k: int = 5) -> DataFrame:
    return top_k(value_counts(users, "city", "user_count"), [F.desc("user_count"), F.asc("city")], k)


def describe_price(products: DataFrame, column: str = "price") -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles, as one row.

    Quartiles are exact: they come from counts per distinct value, not from a sketch.
    """
    value = F.col(column)
    basics = products.agg(
        F.count(value).alias("count"),
        F.round(F.sum(value).cast("double") / F.count(value), 4).alias("mean"),
        F.round(F.stddev_samp(value.cast("double")), 4).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    quartiles = exact_quantiles(products, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    rounded = quartiles.select(*(F.round(c, 4).alias(c) for c in quartiles.columns))
    # Two rows with complementary columns, folded into one.
    both = basics.unionByName(rounded, allowMissingColumns=True)
    names = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return both.agg(F.max("count").alias("count"), *(F.max(c).cast("decimal(18,4)").alias(c) for c in names))


def preview(df: DataFrame, k: int = 5) -> DataFrame:
    """Any ``k`` rows."""
    return df.limit(k)


def column_types(df: DataFrame) -> DataFrame:
    """Name and type of every column."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, column_type string")
