"""Ranks and tiles over a whole table or over large groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import materialize
from .windows import with_null_keys, without_null_keys


_BEYOND = 1_000_000  # past every magnitude


def _magnitude(value: Column) -> Column:
    """A step function of ``value``, constant over 0.1 % of its size, that keeps its order.

    At most some 70,000 steps cover all numbers of a decimal(18,2).
    """
    size = F.floor(F.log1p(F.abs(value).cast("double")) * 1000)
    return F.when(value < 0, -size).otherwise(size)


def range_slices(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Store ``rows`` in ranges of ``order`` of even size, numbered ascending in ``name``.

    Spark samples the bounds, so what is summed per slice and the rows themselves must come from one stored partitioning.
    """
    return materialize(rows.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), "range_slices")


def counts_before(
    hist: DataFrame, keys: Sequence[str], value: str, weight: Column, descending: bool, last: Column | None = None
) -> DataFrame:
    """Add ``__before``, the summed ``weight`` of the rows ahead of each row in its group,
    and ``__all``, that of the whole group.

    ``hist`` has one row per (keys, value). Rows are split by magnitude of the value, so
    a group with very many distinct values still runs in many tasks; only one total per
    magnitude meets in a single task. Floating-point values may crowd in one magnitude: they are
    split by sampled ranges instead, see :func:`range_slices`. Rows where ``last`` holds come after all others.
    """
    direction = F.desc if descending else F.asc
    if dict(hist.dtypes)[value] in ("double", "float"):
        ordered = [*([] if last is None else [last.asc()]), direction(value)]
        rows, step_order = range_slices(hist.withColumn("__weight", weight), [*keys, *ordered], "__step"), F.asc("__step")
    else:
        step = F.coalesce(_magnitude(F.col(value)), F.lit(0))
        if last is not None:
            step = F.when(last, -_BEYOND if descending else _BEYOND).otherwise(step)
        rows = hist.withColumn("__step", step).withColumn("__weight", weight)
        ordered, step_order = [direction(value)], direction("__step")
    cell = [*keys, "__step"]
    local = F.sum("__weight").over(W.partitionBy(*cell).orderBy(*ordered).rowsBetween(W.unboundedPreceding, -1))
    steps = rows.groupBy(*cell).agg(F.sum("__weight").alias("__total"))
    ahead = F.sum("__total").over(W.partitionBy(*keys).orderBy(step_order).rowsBetween(W.unboundedPreceding, -1))
    whole = F.sum("__total").over(W.partitionBy(*keys))
    steps = steps.select(*cell, ahead.alias("__ahead"), whole.alias("__all"))
    zero = F.lit(0)
    return (
        rows.withColumn("__local", local)
        .join(steps, cell)
        .withColumn("__before", F.coalesce("__local", zero) + F.coalesce("__ahead", zero))
        .drop("__step", "__weight", "__local", "__ahead")
    )


def rank_within(
    df: DataFrame, by: Sequence[str], metric: str, name: str, dense: bool = False, descending: bool = True
) -> DataFrame:
    """Rank (or dense rank) of each row in its group by ``metric``, NULL metrics last.

    Works on counts per distinct value: the rank is one more than the number of rows (or
    of values) ahead. ``df`` is read more than once; pass a stored table or an aggregate,
    whose shuffle Spark reuses.
    """
    rows, group = without_null_keys(df, by)
    rows, metric_key = without_null_keys(rows, [metric])
    key = [*group, *metric_key]
    hist = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    weight = F.lit(1) if dense else F.col("__rows")
    ranks = counts_before(hist, group, metric, weight, descending, last=F.col(metric_key[1]))
    ranks = ranks.select(*key, (F.col("__before") + 1).alias(name))
    return with_null_keys(rows.join(ranks, key), [*by, metric]).select(*df.columns, name)


def tile_cutoffs(df: DataFrame, value: Column, id_column: str, tiles: int, nulls_last: bool = False) -> list[tuple]:
    """The last (flag, value, id) of every tile but the final one, in ascending order; the flag sorts NULLs.

    The rows are range-partitioned in their own type and stored with the partition number, and counts
    per partition tell where each cut-off lies; only those partitions are read again and sorted. The
    bounds of a range partitioning are sampled, hence the stored table: counts and rows have to come from
    the same partitioning.
    """
    part = df.select(_null_flag(value, nulls_last).alias("flag"), value.alias("value"), F.col(id_column).alias("id"))
    placed = part.repartitionByRange("flag", "value", "id").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "tiles")

    # One row per partition: a list as short as Spark's own partition bounds.
    sizes = {r.part: r.rows for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).collect()}
    total, start = sum(sizes.values()), 0
    last_rows = sorted({i * (total // tiles) + min(i, total % tiles) for i in range(1, tiles)})
    ends = []  # (partition, position in it) of the last row of each tile
    for part, n in sorted(sizes.items()):
        ends += [(part, end - start) for end in last_rows if start < end <= start + n]
        start += n
    if not ends:
        return []
    position = F.row_number().over(W.partitionBy("part").orderBy("flag", "value", "id"))
    at = reduce(lambda x, y: x | y, [(F.col("part") == p) & (F.col("position") == n) for p, n in ends])
    found = (placed.where(F.col("part").isin(sorted({p for p, _ in ends})))
             .withColumn("position", position).where(at).collect())  # at most tiles - 1 rows
    return [(r.flag, r.value, r.id) for r in sorted(found, key=lambda r: (r.part, r.position))]


def _null_flag(value: Column, nulls_last: bool) -> Column:
    return F.when(value.isNull(), 1 if nulls_last else -1).otherwise(0)


def ntile_scores(df: DataFrame, measures: dict[str, Column], id_column: str, tiles: int = 5,
                 where: Column | None = None, nulls_last: Sequence[str] = ()) -> DataFrame:
    """Add one tile number per measure, ascending by (measure, id), without a global sort task.

    NULL measures come first, or last for those in ``nulls_last``. Rows outside ``where`` get NULL. The cut-offs are a
    handful of literals, so scoring itself is a projection of ``df``; ``df`` should be a stored table.
    """
    scored = df if where is None else df.where(where)
    types = dict(df.select(*(value.alias(name) for name, value in measures.items())).dtypes)
    columns = {}
    for name, value in measures.items():
        flag, tile = _null_flag(value, name in nulls_last), F.lit(1)
        for cut_flag, cut_value, cut_id in tile_cutoffs(scored, value, id_column, tiles, name in nulls_last):
            cut = F.lit(cut_value).cast(types[name])
            later = F.col(id_column) > F.lit(cut_id)
            same = value.eqNullSafe(cut) & later
            beyond = (flag > cut_flag) | ((flag == cut_flag) & (F.coalesce(value > cut, F.lit(False)) | same))
            tile = tile + F.when(beyond, 1).otherwise(0)
        columns[name] = tile if where is None else F.when(where, tile)
    return df.withColumns(columns)


def exact_quantiles(df: DataFrame, column: str, fractions: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated quantiles, from counts per distinct value."""
    hist = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__rows"))
    ranked = counts_before(hist, [], column, F.col("__rows"), descending=False)
    ranked = ranked.withColumnRenamed("__all", "__n")
    picks = []
    for name, fraction in fractions.items():
        position = F.lit(fraction) * (F.col("__n") - 1)
        for end, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("__before") <= index) & (index < F.col("__before") + F.col("__rows"))
            picks.append(F.max(F.when(here, F.col(column))).cast("double").alias(f"__{end}_{name}"))
    found = ranked.agg(F.max("__n").alias("__n"), *picks)
    exprs = []
    for name, fraction in fractions.items():
        position = F.lit(fraction) * (F.col("__n") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        exprs.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return found.select(exprs)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows; each task keeps ``k`` of its own (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
