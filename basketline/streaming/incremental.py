"""Incremental loads driven by the time of the last loaded row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import hadoop_path, path_exists

_BEFORE_ALL = "0001-01-01 00:00:00"


def last_load_time(spark: SparkSession, state_dir: str, name: str) -> str:
    """The newest time loaded so far, as text; a time before all data at first."""
    path = f"{state_dir.rstrip('/')}/{name}_marks"
    if not path_exists(spark, path):
        return _BEFORE_ALL
    marks = spark.read.schema("last_load_time timestamp_ntz, loaded_rows bigint").parquet(path)
    newest = marks.agg(F.max("last_load_time").cast("string").alias("t")).first().t
    return newest or _BEFORE_ALL


def _loads(spark: SparkSession, state_dir: str, name: str) -> int:
    """How many loads have stored rows."""
    path = f"{state_dir.rstrip('/')}/{name}_marks"
    return spark.read.schema("loaded_rows bigint").parquet(path).count() if path_exists(spark, path) else 0


def incremental_load(
    spark: SparkSession, source: DataFrame, target: str, state_dir: str, name: str, time_column: str,
    upto: dt.datetime | str | None = None, key: Sequence[str] | None = None,
) -> int:
    """Append the rows of ``source`` newer than the last load, then record the new mark.

    Each load is a folder of its own named after its lower mark and written as a whole, so
    a load that failed before its mark is simply overwritten by the next attempt, and no
    row is loaded twice. With ``key``, a load takes every row whose key no load has stored: late
    rows and rows without a time too. Without it the filter reaches the source scan, rows without a time
    belong to the first load, and rows that arrive later with a time at or before the mark
    are not picked up. Returns the number of rows loaded.
    """
    since = last_load_time(spark, state_dir, name)
    time = F.col(time_column)
    done = _loads(spark, state_dir, name)
    newer = time > F.lit(since).cast("timestamp_ntz")
    fresh = source if key else source.where(newer if done else newer | time.isNull())
    if upto is not None:
        fresh = fresh.where(time.isNull() | (time <= F.lit(str(upto)).cast("timestamp_ntz")))
    if key and done:
        stored = read_loaded(spark, target).select(*[F.col(c).alias(f"__{c}") for c in key])
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key))
        fresh = fresh.join(stored, same, "left_anti")
    label = "".join(ch if ch.isalnum() else "-" for ch in since) + (f"-{done}" if done else "")
    path = f"{target.rstrip('/')}/load_after={label}"
    fresh.write.mode("overwrite").parquet(path)

    loaded = spark.read.schema(fresh.schema).parquet(path)
    mark = loaded.agg(F.max(time_column).alias("last_load_time"), F.count(F.lit(1)).alias("loaded_rows"))
    row = mark.first()
    if row.loaded_rows == 0:
        fs, empty = hadoop_path(spark, path)
        fs.delete(empty, True)
        return 0
    mark = mark.select(F.col("last_load_time").cast("timestamp_ntz"), "loaded_rows")
    mark.coalesce(1).write.mode("append").parquet(f"{state_dir.rstrip('/')}/{name}_marks")
    return row.loaded_rows


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """All loads so far; ``load_after`` tells them apart."""
    return spark.read.option("recursiveFileLookup", False).parquet(target)
