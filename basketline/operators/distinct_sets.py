"""Distinct counts that roll up: sets of numbered members as bitmaps, one union away from any coarser group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import materialize
from .lookups import looked_up

SLICE_ROWS = 500_000


def dense_numbers(members: DataFrame, key: str, name: str = "number", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """A stored dictionary of the distinct values of ``key``, numbered from 1 without gaps. NULL has no number.

    Numbers are given within hash slices of about ``slice_rows`` members and moved by the sizes of the slices before, so
    no task sees all members. The same members get the same numbers.
    """
    distinct = materialize(members.select(key).where(F.col(key).isNotNull()).distinct(), "members")
    slices = max(1, math.ceil(distinct.count() / slice_rows))
    placed = distinct.withColumn("__slice", F.pmod(F.xxhash64(key), F.lit(slices)))
    before = F.sum("__n").over(W.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1))
    sizes = placed.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n")).select("__slice", F.coalesce(before, F.lit(0)).alias("__before"))
    row = F.row_number().over(W.partitionBy("__slice").orderBy(key))
    numbered = placed.withColumn("__row", row).join(sizes, "__slice")
    return materialize(numbered.select(key, (F.col("__before") + F.col("__row")).alias(name)), "member_numbers")


def with_numbers(rows: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """``rows`` with the number of their ``key``; NULL where it has none."""
    return rows.join(looked_up(numbers), key, "left")


def member_sets(rows: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """Per group and bucket of 32,768 numbers, the set of the numbers that occur, as a bitmap: by, bucket, members.

    A bitmap has 4 kB however many rows it stands for, so repeated rows and hot groups end in the map-side aggregate, and a group
    is spread over its buckets. Rows without a number are in no set.
    """
    known = rows.where(F.col(number).isNotNull())
    position = F.bitmap_bit_position(number)
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(position).alias("members"))


def distinct_over(sets: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Exact distinct members per coarser group of :func:`member_sets`: the union of bitmaps per bucket, then their sizes."""
    groups = [F.col(c) if isinstance(c, str) else c for c in by]
    merged = sets.groupBy(*groups, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("__n"))
    names = [c for c in merged.columns if c not in ("bucket", "__n")]
    return merged.groupBy(*names).agg(F.sum("__n").alias(name))
