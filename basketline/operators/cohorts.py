"""Behaviour of users over days: cohorts, funnels, streaks, intervals.

All of them first reduce the facts to one row per user and day. What remains of a heavy
user is at most one row per calendar day, so windows per user stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.money import percent
from ..functions.rules import bucketize

# Days after the first one that count as retained.
HORIZONS = {"d1": (1, 1), "d7": (1, 7), "d30": (1, 30)}


def retention(
    df: DataFrame, user: str, day: str, horizons: dict[str, tuple[int, int]] = HORIZONS
) -> DataFrame:
    """Per first day: users, and those active again within each horizon, with percentages."""
    daily = df.select(F.col(user).alias("user"), F.col(day).alias("day")).distinct()
    age = F.datediff("day", F.min("day").over(W.partitionBy("user")))
    daily = daily.select("user", "day", age.alias("age"), F.min("day").over(W.partitionBy("user")).alias("first_date"))
    # Still partitioned by user: no further shuffle until the small per-day totals.
    returned = {
        name: F.max(F.when(F.col("age").between(*span), 1).otherwise(0)).alias(name)
        for name, span in horizons.items()
    }
    users = daily.groupBy("user", "first_date").agg(*returned.values())  # users without a day are a cohort too
    known = F.col("user").isNotNull()
    totals = users.groupBy("first_date").agg(
        F.count("user").alias("new_users"),
        *(F.sum(F.when(known, F.col(n)).otherwise(0)).alias(f"{n}_retained") for n in horizons),
    )
    columns = ["first_date", "new_users"]
    for name in horizons:
        kept = F.col(f"{name}_retained")
        columns += [kept, percent(kept, F.col("new_users")).alias(f"{name}_retention_pct")]
    return totals.select(columns).orderBy("first_date")


def funnel(df: DataFrame, user: str, steps: dict[str, Column]) -> DataFrame:
    """Distinct users that meet each step's condition at least once, as one row."""
    flags = [F.max(F.when(condition, 1).otherwise(0)).alias(name) for name, condition in steps.items()]
    users = df.where(F.col(user).isNotNull()).groupBy(user).agg(*flags)
    return users.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in steps))


def streaks(df: DataFrame, user: str, day: str, min_days: int, distinct_users: bool = False) -> DataFrame:
    """Lengths of runs of consecutive active days and how many runs have that length."""
    daily = df.select(F.col(user).alias("user"), F.col(day).alias("day")).distinct()
    number = F.row_number().over(W.partitionBy("user").orderBy("day"))
    runs = (
        daily.withColumn("run", F.date_sub("day", number))
        .groupBy("user", "run").agg(F.count(F.lit(1)).alias("consecutive_days"))
        .where(F.col("consecutive_days") >= min_days)
    )
    if not distinct_users:
        out = runs.groupBy("consecutive_days").agg(F.count(F.lit(1)).alias("run_count"))
    else:
        per_user = runs.groupBy("consecutive_days", "user").agg(F.count(F.lit(1)).alias("n"))
        out = per_user.groupBy("consecutive_days").agg(
            F.sum("n").alias("run_count"), F.count("user").alias("distinct_users")
        )
    return out.orderBy("consecutive_days")


def interval_histogram(
    df: DataFrame, user: str, day: str, bins: Sequence[tuple[int, str]], rest: str, share: bool = True
) -> DataFrame:
    """Days between consecutive events of a user, counted per bin, smallest interval first.

    Events of one day are 0 days apart, so the counts per user and day hold all
    intervals: n - 1 zeros within the day and one step from the day before. Events without a day have none.
    """
    daily = df.groupBy(F.col(user).alias("user"), F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    before = F.lag("day").over(W.partitionBy("user").orderBy("day"))
    gaps = daily.select(F.datediff("day", before).alias("gap"), F.when(F.col("day").isNotNull(), F.col("events") - 1).otherwise(0).alias("same_day"))
    by_gap = gaps.groupBy("gap").agg(F.count("gap").alias("steps"), F.sum("same_day").alias("same_day"))
    # From here on one row per distinct interval.
    both = F.explode(F.array(
        F.struct(F.col("gap").alias("days"), F.col("steps").alias("n")),
        F.struct(F.lit(0).alias("days"), F.col("same_day").alias("n")),
    ))
    binned = (
        by_gap.select(both.alias("g")).select("g.days", "g.n").where("n > 0")
        .groupBy(bucketize(F.col("days"), bins, rest).alias("interval_range"))
        .agg(F.sum("n").alias("repurchase_count"), F.min("days").alias("__first"))
    )
    columns = ["interval_range", "repurchase_count"]
    if share:
        everything = F.sum("repurchase_count").over(W.partitionBy())  # one row per bin
        binned = binned.withColumn("pct", percent(F.col("repurchase_count"), everything))
        columns.append("pct")
    return binned.orderBy("__first").select(columns)
