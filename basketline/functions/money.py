"""Exact decimal ratios.

Totals and counts are divided as wide decimals and rounded once, half up. ``avg`` on a
decimal(12,2) would round to six places first, and doubles would depend on the order
in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def ratio(numerator: Column, denominator: Column, scale: int = 2, numerator_type: str = "decimal(22,2)") -> Column:
    """``numerator / denominator`` rounded to ``scale``; NULL when the denominator is 0."""
    bottom = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(numerator.cast(numerator_type) / bottom, scale).cast(f"decimal(18,{scale})")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two places, NULL for an empty whole."""
    return ratio(part * 100, whole)


def money(total: Column) -> Column:
    return total.cast(MONEY)
