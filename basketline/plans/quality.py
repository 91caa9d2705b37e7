"""Data quality: table checks with one row per check, and the gate of the pipeline."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import ORDER_STATUSES, PUBLISHED_ROW_BANDS, SUSPICIOUS_AMOUNT
from ..operators.lookups import looked_up
from ..operators.summaries import having_duplicates
from ..schemas import TEXT_WIDTHS


class QualityError(RuntimeError):
    """A check of the gate failed."""


def _result(observed: DataFrame, check: str, table: str, low: int | None, high: int | None) -> DataFrame:
    """One row: the measured value, its limits, PASS or FAIL."""
    value = F.coalesce(F.col("observed"), F.lit(0)).cast("bigint")
    passed = F.lit(True)
    if low is not None:
        passed = passed & (value >= low)
    if high is not None:
        passed = passed & (value <= high)
    return observed.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        value.alias("observed"),
        F.lit(low).cast("bigint").alias("limit_low"),
        F.lit(high).cast("bigint").alias("limit_high"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _measures(df: DataFrame, table: str, measures: dict[str, tuple[Column, int | None, int | None]]) -> DataFrame:
    """Several aggregate measures of one table, taken in one pass, one row each."""
    values = df.agg(*(expr.cast("bigint").alias(name) for name, (expr, _, _) in measures.items()))
    rows = F.array(*(
        F.struct(
            F.lit(name).alias("check"), F.col(name).alias("observed"),
            F.lit(low).cast("bigint").alias("limit_low"), F.lit(high).cast("bigint").alias("limit_high"),
        )
        for name, (_, low, high) in measures.items()
    ))
    checks = values.select(F.explode(rows).alias("m")).select("m.*")
    observed = F.coalesce(F.col("observed"), F.lit(0))
    passed = F.coalesce(observed >= F.col("limit_low"), F.lit(True)) & F.coalesce(
        observed <= F.col("limit_high"), F.lit(True)
    )
    return checks.select(
        "check", F.lit(table).alias("table"), observed.alias("observed"), "limit_low", "limit_high",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def dq_row_bands(tables: Mapping[str, DataFrame], bands: Mapping[str, tuple[int, int]] = PUBLISHED_ROW_BANDS) -> DataFrame:
    """Row count of each table against its accepted band, both ends included."""
    return _union([
        _result(tables[name].agg(F.count(F.lit(1)).alias("observed")), "row_count", name, low, high)
        for name, (low, high) in bands.items()
    ])


def require(checks: DataFrame | list) -> list:
    """Raise unless every check passed; ``checks`` has one row per check, as a frame or collected."""
    rows = checks if isinstance(checks, list) else checks.collect()
    failed = [f"{r.check} of {r.table}: {r.observed}" for r in rows if r.status != "PASS"]
    if failed:
        raise QualityError("; ".join(failed))
    return rows


def dq_orders(orders: DataFrame) -> DataFrame:
    """Missing users and amounts, non-positive and suspicious amounts, in one pass."""
    return _measures(orders, "ods_orders", order_measures())


def order_measures() -> dict[str, tuple[Column, int | None, int | None]]:
    """The aggregates of :func:`dq_orders` with their limits."""
    amount = F.col("total_amount")
    return {
        "total": (F.count(F.lit(1)), None, None),
        "null_user": (F.count_if(F.col("user_id").isNull()), 0, 0),
        "null_amount": (F.count_if(amount.isNull()), 0, 0),
        "invalid_amount": (F.count_if(amount <= 0), 0, 0),
        "suspicious_amount": (F.count_if(amount > SUSPICIOUS_AMOUNT), 0, 0),
    }


def dq_first_orders(dwd_orders: DataFrame) -> DataFrame:
    """First-order flags must be as many as users with orders: the difference is reported. Orders without a user are left out."""
    users = dwd_orders.where("user_id IS NOT NULL").groupBy("user_id").agg(F.sum("is_first_order").alias("firsts"))
    gap = users.agg(F.abs(F.sum("firsts") - F.count("user_id")).alias("observed"))
    return _result(gap, "first_orders_vs_users", "dwd_orders", 0, 0)


def dq_primary_key(df: DataFrame, table: str, key: Sequence[str], together: bool = False) -> DataFrame:
    """Key values that occur twice, and rows with a missing key column. ``together``: see :func:`having_duplicates`."""
    duplicates = having_duplicates(df, key, together).agg(F.count(F.lit(1)).alias("observed"))
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))
    nulls = df.agg(F.count_if(missing).alias("observed"))
    return _union([
        _result(duplicates, "duplicate_keys", table, 0, 0),
        _result(nulls, "null_keys", table, 0, 0),
    ])


def dq_primary_keys(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], together: Collection[str] = (),
) -> DataFrame:
    """:func:`dq_primary_key` of several tables, two rows each. ``together`` names those bucketed by a column of their key."""
    return _union([dq_primary_key(tables[name], name, key, name in together) for name, key in keys.items()])


def dq_status_domain(orders: DataFrame) -> DataFrame:
    """Orders in a state outside the five known ones (also wrong case or missing)."""
    unknown = ~F.coalesce(F.col("status").isin(*ORDER_STATUSES), F.lit(False))
    return _result(orders.agg(F.count_if(unknown).alias("observed")), "unknown_status", "ods_orders", 0, 0)


def dq_orphans(orders: DataFrame, items: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Orders without a known user, items without a known order or product.

    Rows are counted per key before the join, so a key moves once per map task and a
    frequent one cannot overload the join.
    """
    def orphans(rows: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = counts.join(looked_up(parent.select(key), parent.count()), key, "left_anti").agg(F.sum("n").alias("observed"))
        return _result(lost, f"unknown_{key}", table, 0, 0)

    return _union([
        orphans(orders, "ods_orders", "user_id", users),
        orphans(items, "ods_order_items", "order_id", orders),
        orphans(items, "ods_order_items", "product_id", products),
    ])


def dq_header_vs_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose amount differs from the sum of their items; no items count as 0."""
    sums = items.groupBy("order_id").agg(F.sum("amount").alias("items_total"))
    differs = ~F.col("total_amount").eqNullSafe(F.coalesce("items_total", F.lit(0)))
    joined = orders.select("order_id", "total_amount").join(sums, "order_id", "left")
    return _result(joined.agg(F.count_if(differs).alias("observed")), "amount_differs_from_items", "ods_orders", 0, 0)


def dq_rejected_rows(loaded: DataFrame, rejected: DataFrame, table: str) -> DataFrame:
    """Records of a checked file: all, loaded, and rejected by reason (none may be)."""
    counts = loaded.agg(F.count(F.lit(1)).alias("n")).select(F.lit("loaded").alias("check"), "n").union(
        rejected.groupBy(F.concat(F.lit("rejected: "), "reason").alias("check")).agg(F.count(F.lit(1)).alias("n")))
    counts = counts.union(counts.agg(F.lit("records").alias("check"), F.sum("n").alias("n")))
    limit = F.when(F.col("check").startswith("rejected: "), 0).cast("bigint")
    return counts.select(
        "check", F.lit(table).alias("table"), F.col("n").alias("observed"), limit.alias("limit_low"), limit.alias("limit_high"),
        F.when(limit.isNull() | (F.col("n") == 0), "PASS").otherwise("FAIL").alias("status"))


def dq_text_widths(df: DataFrame, table: str) -> DataFrame:
    """Longest text of each column against its declared width."""
    return _measures(df, table, {
        f"longest_{column}": (F.max(F.length(column)), None, width)
        for column, width in TEXT_WIDTHS[table].items()
    })
