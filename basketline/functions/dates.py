"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day that recency is measured from; today when not given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def iso_weekday(day: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(day) + 1


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def whole_minutes(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end``, truncated toward zero.

    Taken from the interval itself, so no session time zone enters the result.
    """
    gap = end - start
    part = lambda unit: F.extract(F.lit(unit), gap)
    return (part("DAY") * 1440 + part("HOUR") * 60 + part("MINUTE")).cast("int")


def average_gap(first_day: Column, last_day: Column, active_days: Column) -> Column:
    """Mean days between distinct active days; 0 for a single day or none."""
    gap = F.datediff(last_day, first_day).cast("decimal(12,0)") / (active_days - 1).cast("decimal(20,0)")
    return F.when(active_days > 1, F.round(gap, 2)).otherwise(F.lit(0)).cast("decimal(10,2)")
