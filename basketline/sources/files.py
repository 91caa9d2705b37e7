"""CSV files with a header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..storage import path_exists

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def is_temporal_name(name: str) -> bool:
    """Columns are taken for dates or times by their name."""
    return "time" in name.lower() or "date" in name.lower()


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a field of the file holds a line break, so that the file cannot be split at its lines.

    The first line of such a field opens a quote that it does not close: it has an odd number of quotes. A stray quote
    in a plain field counts too, which only costs speed. The lines are scanned by many tasks.
    """
    odd = F.length(F.col("value")) - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).where(odd % 2 == 1).limit(1).count())


def read_csv(
    spark: SparkSession, path: str, schema: StructType, parse_dates: Sequence[str] | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """Scan a headered CSV into the declared types.

    Dates and times are read as text and parsed leniently; ``parse_dates`` names them when
    the names alone do not tell. Quotes inside a quoted field are doubled, and a field may hold line breaks. A file with such a field
    is read by one task (``multiline``); others are split. Without a choice, :func:`has_quoted_breaks` tells. A header that
    differs from the schema raises, instead of shifting columns silently.
    """
    if multiline is None:
        multiline = has_quoted_breaks(spark, path)
    temporal = [f.name for f in schema.fields if is_temporal_name(f.name)] if parse_dates is None else parse_dates
    raw = StructType([
        StructField(f.name, StringType() if f.name in temporal else f.dataType) for f in schema.fields
    ])
    df = spark.read.schema(raw).option("header", True).option("enforceSchema", False)
    df = df.option("escape", '"').option("multiLine", multiline).csv(path)
    return parse_temporal(df, {name: schema[name].dataType.simpleString() for name in temporal})


def parse_temporal(df: DataFrame, columns: dict[str, str] | Sequence[str] | None = None) -> DataFrame:
    """Turn text into dates or times; empty and unparsable text becomes NULL.

    Without ``columns``, every text column with a temporal name is parsed as a time.
    """
    if columns is None:
        columns = [name for name, kind in df.dtypes if kind == "string" and is_temporal_name(name)]
    if not isinstance(columns, dict):
        columns = {name: "timestamp_ntz" for name in columns}
    parsed = {}
    for name, kind in columns.items():
        text = F.nullif(F.trim(F.col(name)), F.lit(""))
        text = F.regexp_replace(text, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
        text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=\D|$)", "$1-$2-$3")
        # A time given for a date column is cut to its day.
        time = text.try_cast("timestamp_ntz")
        parsed[name] = time.cast("date") if kind == "date" else time.cast(kind)
    return df.withColumns(parsed) if parsed else df


def read_optional(spark: SparkSession, path: str, schema: StructType, multiline: bool | None = None) -> DataFrame:
    """Like :func:`read_csv`, but a missing file gives an empty frame and a message."""
    if not path_exists(spark, path):
        print(f"missing input, 0 rows loaded: {path}")
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema, multiline=multiline)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a headered CSV folder; NULL is an empty field, times have no fraction."""
    (
        df.write.mode("overwrite").option("header", True)
        .option("timestampNTZFormat", TIME_FORMAT).option("timestampFormat", TIME_FORMAT)
        .option("emptyValue", "").option("escape", '"').csv(path)
    )
