"""Loads of what has arrived in a folder since the last load, whatever times the rows carry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..storage import path_exists


def load_arrivals(
    spark: SparkSession, landing: str, target: str, state_dir: str, schema: StructType, load: int,
    file_format: str = "parquet", options: Mapping[str, str] | None = None, max_files: int | None = None,
) -> None:
    """Append the rows of every file in ``landing`` that no earlier load has taken, then stop.

    A stream over the folder whose checkpoint (``state_dir``) remembers the files it has seen. There is no time mark, so late rows
    and rows without a time load like any others. Each file is loaded exactly once: a run that was killed after writing but before
    the checkpoint noted it writes nothing again, and files that a killed run left behind are not in the sink's log, so no
    reader sees them. ``load`` is stored with the rows, as ``load_number``.

    Files must be complete when they appear in ``landing`` (moved there), and do not change afterwards. ``max_files`` bounds the files
    of a batch, so that a long backlog is loaded in several commits.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(landing).withColumn("load_number", F.lit(load))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", state_dir).trigger(availableNow=True)
    writer.start(target).awaitTermination()


def read_arrivals(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All rows loaded so far, with their ``load_number``."""
    full = StructType([*schema.fields, StructField("load_number", IntegerType())])
    if not path_exists(spark, f"{target.rstrip('/')}/_spark_metadata"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(target)
