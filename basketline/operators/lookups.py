"""The smaller side of a join, kept out of the driver unless it has few rows.

Without a hint the planner sets the size of the compressed files it reads, less the columns left out, against its broadcast limit.
Millions of regular keys are a few megabytes there and some hundred once the driver has collected them for a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 100_000  # some 10 to 30 MB in a broadcast


def looked_up(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` for a join by equal keys: the planner decides for up to ``ROWS`` rows, beyond that the join sorts and sends nothing to the driver.

    ``rows`` is their number or a bound, counted if it is not given.
    """
    n = df.count() if rows is None else rows
    return df if n <= ROWS else df.hint("merge")
