"""Stored tables: Parquet folders of one warehouse, or tables of a catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..schemas import SCHEMAS, conform
from ..storage import hadoop_path, materialize, path_exists
from .checked import MalformedRecords, read_csv_checked
from .files import read_optional

# Raw file of each ODS table, in loading order.
ODS_FILES = {
    "ods_users": "users.csv",
    "ods_products": "products.csv",
    "ods_orders": "orders.csv",
    "ods_order_items": "order_items.csv",
}


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def overwrite(df: DataFrame, path: str, partition_by: str | None = None,
              seen: Observation | None = None, metrics: Sequence[Column] = ()) -> None:
    """Replace the table at ``path``.

    The rows are written beside the old table, which goes only when they are complete: a write
    that fails leaves the old content as it was. The swap is two renames, so readers that open
    the table in between miss it; on an object store a rename copies.

    With a partition column the rows are first rebalanced on it: without that, every task
    would leave a file in every partition; and a plain hash on it would put a busy month
    into one task, whereas a rebalance splits large partitions and joins small ones.

    ``metrics`` are aggregates that the writing tasks take along, for ``seen`` to report. They sit above the last shuffle, where
    a repeated task counts once.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if seen is not None:
        df = df.observe(seen, *metrics)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    fs, target = hadoop_path(df.sparkSession, path)
    target = fs.makeQualified(target)
    beside = f"{target.getParent().toString()}/_{target.getName()}-{uuid.uuid4().hex[:12]}"
    (_, fresh), (_, old) = (hadoop_path(df.sparkSession, f"{beside}-{what}") for what in ("new", "old"))
    try:
        writer.parquet(fresh.toString())
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(fresh, target):
            if fs.exists(old):
                fs.rename(old, target)
            raise OSError(f"cannot put the new rows at {path}")
        fs.delete(old, True)
    finally:
        fs.delete(fresh, True)


def append(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add rows to the table at ``path``; executors write their partitions in parallel.

    With ``batch``, the rows go to a folder of that name as a whole, so that a batch which is stored already is left alone
    and one that was cut off is written again: repeating an append changes nothing. Tells whether rows were written.
    """
    if batch is None:
        df.write.mode("append").parquet(path)
        return True
    folder = f"{path.rstrip('/')}/batch={batch}"
    if path_exists(df.sparkSession, f"{folder}/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(folder)
    return True


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    """Add rows to a database table, ``batch_rows`` per round trip, one connection per task."""
    df.write.mode("append").format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **options
    ).save()


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """Scan a stored table. Partition columns beyond the declared ones come last."""
    return spark.read.parquet(f"{warehouse.rstrip('/')}/{name}")


def save_as_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0, path: str | None = None) -> None:
    """Replace a catalog table, optionally bucketed so that joins on that key need no shuffle, and kept at ``path``.

    Rows are moved to their buckets before the write, so each bucket is one file instead of one a task.
    """
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def load_ods_table(
    spark: SparkSession, source_dir: str, name: str, warehouse: str, multiline: bool | None = None,
    max_rejected: int | None = 0, seen: Observation | None = None, metrics: Sequence[Column] = (),
) -> DataFrame:
    """Load one raw file into the warehouse and return the stored table.

    Records that do not fit are stored as ``<name>_rejected`` with the reason; more than ``max_rejected`` of them raise, and the
    table keeps its old rows.
    """
    path, stored = f"{source_dir.rstrip('/')}/{ODS_FILES[name]}", f"{warehouse.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        loaded = read_optional(spark, path, SCHEMAS[name])
        rejected = spark.createDataFrame([], "record string, reason string")
    else:
        checked = read_csv_checked(spark, path, SCHEMAS[name], multiline=multiline)
        loaded, rejected = checked.loaded, checked.rejected
    overwrite(rejected, f"{stored}_rejected")
    if max_rejected is not None:
        bad = spark.read.parquet(f"{stored}_rejected")
        if (n := bad.count()) > max_rejected:
            reasons = ", ".join(f"{r['n']} {r['reason']}" for r in bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect())
            raise MalformedRecords(f"{path}: {n} records do not fit ({reasons}); see {stored}_rejected")
    overwrite(conform(loaded, name), stored, None, seen, metrics)
    return read_table(spark, warehouse, name)


def load_ods(
    spark: SparkSession, source_dir: str, warehouse: str | None = None, multiline: bool | None = None,
    max_rejected: int | None = 0,
) -> dict[str, DataFrame]:
    """Load the four raw files in order, typed; store them when ``warehouse`` is given, as :func:`load_ods_table` does.

    A missing file loads as an empty table; a missing folder raises. Without a warehouse, values that do not fit are NULL.
    """
    if not path_exists(spark, source_dir):
        raise FileNotFoundError(f"no such source folder: {source_dir}")
    tables = {}
    for name, file in ODS_FILES.items():
        if warehouse is not None:
            tables[name] = load_ods_table(spark, source_dir, name, warehouse, multiline, max_rejected)
        else:
            path = f"{source_dir.rstrip('/')}/{file}"
            tables[name] = conform(read_optional(spark, path, SCHEMAS[name], multiline), name)
    return tables


def with_columns_from(base: DataFrame, derived: DataFrame, key: str) -> DataFrame:
    """Update ``base`` from ``derived``, one row per key: matched rows take its columns.

    Rows without a match keep what they have, NULL for new columns.
    """
    incoming = [c for c in derived.columns if c != key]
    renamed = derived.select(key, F.lit(True).alias("__match"), *(F.col(c).alias(f"__new_{c}") for c in incoming))
    joined = base.join(renamed, key, "left")
    updates: dict[str, Column] = {}
    for c in incoming:
        updates[c] = (
            F.when(F.col("__match"), F.col(f"__new_{c}")).otherwise(F.col(c)) if c in base.columns
            else F.col(f"__new_{c}")
        )
    order = [*base.columns, *(c for c in incoming if c not in base.columns)]
    return joined.select(*(updates.get(c, F.col(c)).alias(c) for c in order))


def update_partitions(spark: SparkSession, path: str, derived: DataFrame, key: str, partition_by: str) -> int:
    """:func:`with_columns_from` on the stored table at ``path``, rewriting only the partitions that hold a matched row.

    Files of other partitions stay as they are. ``derived`` has existing columns only, and not the partition column. The new
    partitions are complete in the shared folder before the old ones go; an update that is cut off is repeated as a whole. Returns the
    number of partitions rewritten, whose names are all that reaches the driver.
    """
    base = spark.read.parquet(path)
    unknown = set(derived.columns) - set(base.columns) | {partition_by} & set(derived.columns)
    if unknown:
        raise ValueError(f"cannot update {sorted(unknown)}")
    matched = base.select(key, partition_by).join(derived.select(key), key, "left_semi")
    touched = [r[0] for r in matched.select(partition_by).distinct().collect()]
    if not touched:
        return 0
    inside = F.col(partition_by).isin([v for v in touched if v is not None])
    if None in touched:
        inside = inside | F.col(partition_by).isNull()
    fresh = materialize(with_columns_from(base.where(inside), derived, key).select(base.columns), "updated_partitions")
    writer = fresh.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)
    return len(touched)
