"""Counts, shares and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.money import percent
from .slices import spread


def share_of_total(df: DataFrame, by: str, count_name: str = "cnt") -> DataFrame:
    """Rows per value of ``by`` and their percentage of all rows, largest first."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias(count_name))
    everything = F.sum(count_name).over(W.partitionBy())  # one row per value: a report
    return counts.withColumn("pct", percent(F.col(count_name), everything)).orderBy(F.desc(count_name), by)


def value_counts(df: DataFrame, by: str, count_name: str = "cnt") -> DataFrame:
    """Rows per value, most frequent first; NULLs are not counted."""
    counts = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.desc(count_name), by)


def table_census(tables: dict[str, DataFrame], measures: dict[str, dict[str, Column]] | None = None,
                 count_name: str = "rows_count") -> DataFrame:
    """One row per table: its row count and the optional extra ``measures``.

    ``measures`` maps a column name to {table: aggregate}; a table without the measure
    gets NULL.
    """
    measures = measures or {}
    rows = []
    for name, df in tables.items():
        extra = [
            (per_table.get(name, F.lit(None))).cast("bigint").alias(measure)
            for measure, per_table in measures.items()
        ]
        rows.append(df.agg(F.count(F.lit(1)).alias(count_name), *extra).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, rows)


def database_census(spark: SparkSession, database: str) -> DataFrame:
    """Row count of every table of a catalog database."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    if not names:
        return spark.range(0).select(F.lit("").alias("table_name"), F.col("id").alias("rows_count"))
    return table_census({name: spark.table(f"`{database}`.`{name}`") for name in names})


def having_duplicates(df: DataFrame, key: Sequence[str], together: bool = False) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    ``together`` tells that ``df`` is bucketed by a column of the key, so that its rows need not move.
    """
    keys = df.select(*key) if together else spread(df.select(*key), key)
    return keys.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_count")).where(F.col("rows_count") > 1)


def report(df: DataFrame, title: str, rows: int = 50) -> None:
    """Print a small result. Only for aggregates and top-k reports."""
    print(title)
    df.show(rows, truncate=False)
