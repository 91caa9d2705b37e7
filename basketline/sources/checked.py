"""CSV files whose malformed records are set aside and counted instead of losing values silently."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..storage import materialize
from .files import has_quoted_breaks, is_temporal_name, parse_temporal

CORRUPT = "_corrupt_record"


class MalformedRecords(ValueError):
    """A raw file holds more records than accepted that do not fit its table."""


@dataclass(frozen=True)
class CheckedRows:
    """The rows that fit the schema, and the records that do not, as text with the reason. Together they are all records."""

    loaded: DataFrame
    rejected: DataFrame


def _reason(record: Column, schema: StructType, temporal: Sequence[str]) -> Column:
    """Why a record was set aside: its number of fields, or the first field that its type cannot take.

    The record is taken apart once more with text columns only; there is one more of them, so that a surplus field shows.
    """
    names = [f"c{i}" for i in range(len(schema.fields) + 1)]
    parts = F.from_csv(record, ", ".join(f"{n} string" for n in names), {"escape": '"', "multiLine": "true"})
    reason = F.lit("malformed")
    for name, field in reversed(list(zip(names, schema.fields))):
        if field.name in temporal or isinstance(field.dataType, StringType):
            continue
        text = F.nullif(parts[name], F.lit(""))
        kind = field.dataType.simpleString()
        reason = F.when(text.isNotNull() & F.trim(text).try_cast(kind).isNull(), F.lit(f"{field.name} is not {kind}")).otherwise(reason)
    return F.when(parts[names[-1]].isNotNull(), F.lit("too many fields")).when(
        parts[names[-2]].isNull() & ~record.rlike(r",\s*$"), F.lit("too few fields")).otherwise(reason)


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType, parse_dates: Sequence[str] | None = None,
    multiline: bool | None = None,
) -> CheckedRows:
    """Like :func:`files.read_csv`, but records that do not fit are rejected as a whole.

    A record is rejected when a number cannot be read in its declared type (with its precision) or when it has more or fewer fields
    than the schema. Empty fields are NULL, and times are still read leniently, as everywhere. ``rejected`` has the columns
    record (its text), reason. The file is parsed once and stored, since both parts are read from it.
    """
    temporal = [f.name for f in schema.fields if is_temporal_name(f.name)] if parse_dates is None else parse_dates
    raw = StructType([StructField(f.name, StringType() if f.name in temporal else f.dataType) for f in schema.fields])
    if multiline is None:
        multiline = has_quoted_breaks(spark, path)
    reader = spark.read.schema(StructType([*raw.fields, StructField(CORRUPT, StringType())]))
    reader = reader.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    parsed = materialize(reader.option("escape", '"').option("multiLine", multiline).csv(path), "checked_csv")
    corrupt = F.col(CORRUPT)
    loaded = parse_temporal(parsed.where(corrupt.isNull()).drop(CORRUPT), {n: schema[n].dataType.simpleString() for n in temporal})
    rejected = parsed.where(corrupt.isNotNull()).select(corrupt.alias("record"), _reason(corrupt, schema, temporal).alias("reason"))
    return CheckedRows(loaded, rejected)
