"""Rows moved to small tasks before they are grouped by a key that few of them share.

Grouping such rows where they lie saves nothing and fills a hash table with all rows of a file split, which spills as soon as
splits are large. Moved first, a task holds about ``ROWS`` rows at every size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ROWS = 250_000  # a hash table of these takes some 50 MB
SHARES = 8
SHARE = "__share"


def tasks_of(rows: int) -> int:
    """Tasks of about ``ROWS`` rows."""
    return max(2, -(-rows // ROWS))


def spread(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Rows of equal ``keys`` in one task; grouping by these and further columns moves none again.

    ``rows`` is their number or a bound, counted if it is not given.
    """
    n = df.count() if rows is None else rows
    return df.repartition(tasks_of(n), *keys)


def spread_shares(df: DataFrame, keys: Sequence[str], over: str, rows: int | None = None) -> DataFrame:
    """:func:`spread` with the rows of a key dealt over ``SHARES`` tasks by ``over``, so that a frequent key fills no single task.

    Adds the share as ``__share``, to be one more grouping column.
    """
    shared = df.withColumn(SHARE, F.pmod(F.xxhash64(over), F.lit(SHARES)).cast("int"))
    return spread(shared, [*keys, SHARE], df.count() if rows is None else rows)
