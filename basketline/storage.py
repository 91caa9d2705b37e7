"""Intermediate tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Without that setting only a local master may continue, in a fresh temporary
    folder; on a cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="basketline-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/basketline/{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(
    df: DataFrame, label: str, partition_by: str | None = None, buckets: tuple[str, int] | None = None, codec: str | None = None,
    rows_a_file: int | None = None,
) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, keeps column pruning and filter pushdown for the readers, and
    outlives any executor. A partition column comes last in the result; the rows are
    rebalanced on it, which splits busy values over tasks and merges small ones.

    ``buckets`` is a column and the number of partitions ``df`` has by it: the rows stay in as many buckets, sorted, and grouping
    or joining by that column moves none of them. ``codec`` compresses the files, as the session does if none is given. ``rows_a_file`` bounds the rows
    of a file, and with them those that a reader holds at once.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    if buckets:
        column, n = buckets
        name = path.rsplit("/", 1)[-1].replace("-", "_")
        writer = df.write.format("parquet").option("path", path).bucketBy(n, column).sortBy(column)
        (writer.option("compression", codec) if codec else writer).saveAsTable(name)
        return spark.table(name)
    writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
    writer = writer.option("compression", codec) if codec else writer
    writer = writer.option("maxRecordsPerFile", rows_a_file) if rows_a_file else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, label: str):
    """:func:`materialize` for one step: the table is deleted on leaving, and nothing may read it later.

    The collection asked of the driver's JVM lets Spark remove the shuffle files of jobs that have ended.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, jpath = hadoop_path(spark, path)
        fs.delete(jpath, True)
        spark.sparkContext._jvm.System.gc()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Delete on leaving what :func:`materialize` wrote inside; nothing may read it later."""
    token = _WRITTEN.set([])
    try:
        yield
    finally:
        for path in _WRITTEN.get():
            fs, jpath = hadoop_path(spark, path)
            fs.delete(jpath, True)
        _WRITTEN.reset(token)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) pair of the Hadoop API for ``path``."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Total length and last change of a file or folder, to notice replaced inputs."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return "absent"
    summary = fs.getContentSummary(jpath)
    return f"{summary.getLength()}-{fs.getFileStatus(jpath).getModificationTime()}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with this text."""
    fs, jpath = hadoop_path(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file; none if it is absent."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return ""
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
