"""Ordered per-key operators that no single key can overload.

A window gives each key to one task. So the rows are range-partitioned by key and order, which lays a
heavy key over several slices of even size, and stored; the window runs inside a slice, and a small
table carries the totals of the earlier slices forward. Every table gets this one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import materialize

_SLICE = "__slice"
_NEUTRAL = {"string": "''", "date": "date'0001-01-01'", "timestamp_ntz": "timestamp_ntz'0001-01-01'",
            "timestamp": "timestamp'0001-01-01'", "boolean": "false"}


def without_null_keys(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Replace NULL keys by a neutral value plus a flag column.

    NULLs then form a group in joins as they do in windows, and both hash the same
    columns, so the join reuses the window's partitioning.
    """
    types, keys = dict(df.dtypes), []
    for name in columns:
        neutral = F.expr(_NEUTRAL.get(types[name], f"cast(0 as {types[name]})"))
        df = df.withColumn(f"__null_{name}", F.col(name).isNull())
        df = df.withColumn(name, F.coalesce(F.col(name), neutral))
        keys += [name, f"__null_{name}"]
    return df, keys


def with_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Undo :func:`without_null_keys`."""
    for name in columns:
        df = df.withColumn(name, F.when(~F.col(f"__null_{name}"), F.col(name))).drop(f"__null_{name}")
    return df


def _sliced(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Store ``rows`` in ranges of (keys, order), numbered ascending in ``__slice``.

    Range bounds are sampled, so rows and totals must come from the one stored partitioning.
    """
    placed = rows.repartitionByRange(*keys, *order).withColumn(_SLICE, F.spark_partition_id())
    return materialize(placed, "slices")


def _before(totals: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Per (keys, slice), the sum of ``column`` over the key's earlier slices."""
    earlier = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(*keys, _SLICE, F.sum(column).over(earlier).alias("__before"))


def sequence_number(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "seq"
) -> DataFrame:
    """Number the rows of each key 1, 2, … by ``order``.

    ``order`` must end in a unique column, or ties are numbered arbitrarily.
    """
    def number(keys: Sequence[str]) -> Column:
        return F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint")

    rows, keys = without_null_keys(df, by)
    placed, cell = _sliced(rows, keys, order), [*keys, _SLICE]
    totals = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("__rows"))
    joined = placed.withColumn(name, number(cell)).join(_before(totals, keys, "__rows"), cell)
    joined = joined.withColumn(name, F.col(name) + F.coalesce(F.col("__before"), F.lit(0)))
    return with_null_keys(joined, by).select(*df.columns, name)


def running_sum(
    df: DataFrame, by: Sequence[str], order: str, value: str, name: str = "running"
) -> DataFrame:
    """Sum of ``value`` up to and including the current time; rows of one time share it."""
    kind = df.select(F.sum(value).alias("s")).schema["s"].dataType
    rows, keys = without_null_keys(df, by)
    # Rows of one time are summed first: they share the result, and there may be many.
    rows, (time, missing) = without_null_keys(rows, [order])
    times = rows.groupBy(*keys, time, missing).agg(F.sum(value).alias("__sum"))
    in_time = [F.desc(missing), F.asc(time)]  # rows without a time come first
    placed, cell = _sliced(times, keys, in_time), [*keys, _SLICE]
    totals = placed.groupBy(*cell).agg(F.sum("__sum").alias("__total"))
    local = F.sum("__sum").over(W.partitionBy(*cell).orderBy(*in_time))
    joined = placed.withColumn("__local", local).join(_before(totals, keys, "__total"), cell)
    total = F.coalesce(F.col("__local") + F.col("__before"), F.col("__local"), F.col("__before")).cast(kind)
    joined = joined.select(*keys, time, missing, total.alias(name))
    joined = with_null_keys(rows.join(joined, [*keys, time, missing]), [order])
    return with_null_keys(joined, by).select(*df.columns, name)


def with_previous(
    df: DataFrame, by: Sequence[str], order: Sequence[str], columns: dict[str, str]
) -> DataFrame:
    """Add, for each ``{column: new name}``, the value in the key's previous row."""
    rows, keys = without_null_keys(df, by)
    placed, cell = _sliced(rows, keys, order), [*keys, _SLICE]
    window = W.partitionBy(*cell).orderBy(*order)
    lagged = placed.select("*", *(F.lag(c).over(window).alias(new) for c, new in columns.items()),
                           (F.row_number().over(window) == 1).alias("__first"))
    carried = F.struct(*(F.col(c).alias(c) for c in columns)).alias("__row")
    last = placed.select(*cell, carried, F.lead(F.lit(1)).over(window).isNull().alias("__last")).where("__last")
    by_slice = W.partitionBy(*keys).orderBy(_SLICE)
    last = last.select(*cell, F.lag("__row").over(by_slice).alias("__before"))
    joined = lagged.join(last, cell)
    for c, new in columns.items():
        joined = joined.withColumn(new, F.when(F.col("__first"), F.col("__before")[c]).otherwise(F.col(new)))
    return with_null_keys(joined, by).select(*df.columns, *columns.values())


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Per key, the columns ``keep`` of its first row by ``order``.

    An aggregate, so each map task sends one row per key however often the key occurs.
    ``keep`` must be part of ``order``.
    """
    smallest = F.min(F.struct(*order))
    return df.groupBy(*by).agg(smallest.alias("__min")).select(*by, *(F.col(f"__min.{c}").alias(c) for c in keep))


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark evaluates the bound before the shuffle too (WindowGroupLimit), so a hot key
    sends at most ``n`` rows per map task.
    """
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") <= n).drop("__rn")
