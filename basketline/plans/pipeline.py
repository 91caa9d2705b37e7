"""The whole run: raw files to facts to summaries to the application layer, with a gate."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import as_of_date
from ..schemas import PRIMARY_KEYS
from ..sources.tables import ODS_FILES, load_ods_table, overwrite, read_table
from ..storage import fingerprint, hadoop_path, path_exists, read_text, temporary_tables, write_text
from .ads import ads_daily_kpis
from .dwd import build_dwd_order_items, build_dwd_orders, dwd_items_metrics, dwd_orders_metrics, with_order_month
from .dws import build_date_summary, build_product_summary, build_user_summary
from .quality import QualityError, dq_primary_key, order_measures, require

LEASE_HOURS = 12.0


class AlreadyRunning(RuntimeError):
    """Another run holds the warehouse."""


class _Marker:
    """The file that keeps two runs apart: it names its owner, and ends ``lease_hours`` after it was last renewed."""

    def __init__(self, spark: SparkSession, warehouse: str, lease_hours: float):
        self.spark, self.path, self.lease_hours = spark, f"{warehouse}/_running", lease_hours

    def take(self) -> None:
        fs, marker = hadoop_path(self.spark, self.path)
        if fs.exists(marker):
            idle = time.time() - fs.getFileStatus(marker).getModificationTime() / 1000
            if idle > self.lease_hours * 3600:
                fs.delete(marker, False)  # its run has died: each finished table renews it
        if not fs.createNewFile(marker):
            owner = read_text(self.spark, self.path) or "another run"
            raise AlreadyRunning(f"{self.path} exists: {owner}, which may run until {self.lease_hours} hours after its last table")
        self.renew()

    def renew(self) -> None:
        write_text(self.spark, self.path, f"{self.spark.sparkContext.applicationId} at {dt.datetime.now(dt.timezone.utc).isoformat()}")

    def release(self) -> None:
        fs, marker = hadoop_path(self.spark, self.path)
        fs.delete(marker, False)


@contextmanager
def _only_run(spark: SparkSession, warehouse: str, lease_hours: float):
    """Two runs would overwrite each other's tables: a marker file keeps them apart."""
    marker = _Marker(spark, warehouse, lease_hours)
    marker.take()
    try:
        yield marker
    finally:
        marker.release()


class _RunLog:
    """Finished steps of an unfinished run, each with the fingerprint of all it was made from and what it measured."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.folder = spark, f"{warehouse}/_run"

    def finished(self, name: str, inputs: str) -> dict | None:
        entry = json.loads(read_text(self.spark, f"{self.folder}/{name}") or "{}")
        return entry["measured"] if entry.get("inputs") == inputs else None

    def note(self, name: str, inputs: str, measured: dict) -> None:
        write_text(self.spark, f"{self.folder}/{name}", json.dumps({"inputs": inputs, "measured": measured}))

    def clear(self) -> None:
        fs, folder = hadoop_path(self.spark, self.folder)
        fs.delete(folder, True)


#: What each table is made from.
LINEAGE = {
    "dwd_orders": ("ods_orders", "ods_users"),
    "dwd_order_items": ("ods_order_items", "ods_orders", "ods_products"),
    "dws_user_summary": ("dwd_orders", "dwd_order_items", "ods_users"),
    "dws_product_summary": ("dwd_order_items",),
    "dws_date_summary": ("dwd_orders", "dws_user_summary"),
    "ads_daily_kpis": ("dwd_orders", "dws_date_summary"),
}


def run_pipeline(
    spark: SparkSession, source_dir: str, warehouse: str, as_of: dt.date | str | None = None,
    row_bands: Mapping[str, tuple[int, int]] | None = None, multiline: bool | None = None, max_rejected: int | None = 0,
    lease_hours: float = LEASE_HOURS, after: Callable[[str], None] | None = None,
) -> dict[str, DataFrame]:
    """Reload every layer from the raw files and return the stored tables.

    Each table is computed by one plan and written once; the next layer reads the stored
    table. A failing step raises and later tables keep their old content. The facts are
    stored by order month, so reports on a period skip the other months.

    Raw records that do not fit are stored aside; more than ``max_rejected`` stop the run (None: never). ``multiline`` is that of
    :func:`files.read_csv`.

    *Restart.* A run that fails or is killed leaves a log of its finished tables. The next run goes on after them where the inputs, by
    fingerprint, are the same; a run that ends well clears the log, so the one after it reloads everything. The marker of a killed run
    ends by itself after ``lease_hours`` without a finished table.

    *Measures.* Row counts, build figures and order checks are taken by the writing tasks, and stored as ``build_metrics`` (table,
    metric, value). ``after`` is called with the name of every finished table.
    """
    warehouse = warehouse.rstrip("/")
    if not path_exists(spark, source_dir):
        raise FileNotFoundError(f"no such source folder: {source_dir}")
    day = str(spark.range(1).select(as_of_date(as_of).alias("d")).first().d)
    t: dict[str, DataFrame] = {}
    inputs: dict[str, str] = {}
    measured: dict[str, dict[str, int]] = {}
    with _only_run(spark, warehouse, lease_hours) as marker, temporary_tables(spark):
        log = _RunLog(spark, warehouse)

        def step(name: str, made_from: str, write: Callable[[Observation, Sequence[Column]], None], metrics: Sequence[Column] = ()) -> None:
            """Write a table unless the log has it from the same inputs."""
            inputs[name] = hashlib.sha256(made_from.encode()).hexdigest()
            known = log.finished(name, inputs[name])
            if known is None:
                seen = Observation(f"build_{name}")
                write(seen, [F.count(F.lit(1)).alias("rows"), *metrics])
                known = {k: int(v or 0) for k, v in seen.get.items()}
                log.note(name, inputs[name], known)
                marker.renew()
                if after:
                    after(name)
            measured[name] = known
            t[name] = read_table(spark, warehouse, name)

        def build(name: str, df: Callable[[], DataFrame], partition_by: str | None = None, metrics: Sequence[Column] = ()) -> None:
            made_from = "|".join([name, day, *(inputs[n] for n in LINEAGE[name])])
            step(name, made_from, lambda seen, m: overwrite(df(), f"{warehouse}/{name}", partition_by, seen, m), metrics)

        for name, file in ODS_FILES.items():
            state = f"{name}|{max_rejected}|{fingerprint(spark, f'{source_dir.rstrip('/')}/{file}')}"
            checks = [c.alias(n) for n, (c, _, _) in order_measures().items()] if name == "ods_orders" else []
            step(name, state, lambda seen, m, name=name: load_ods_table(
                spark, source_dir, name, warehouse, multiline, max_rejected, seen, m), checks)

        build("dwd_orders", lambda: with_order_month(build_dwd_orders(t["ods_orders"], t["ods_users"]), "create_time"),
              "order_month", dwd_orders_metrics())
        build("dwd_order_items", lambda: with_order_month(
            build_dwd_order_items(t["ods_order_items"], t["ods_orders"], t["ods_products"]), "order_time"),
              "order_month", dwd_items_metrics())

        keys = hashlib.sha256("|".join(inputs.values()).encode()).hexdigest()
        if log.finished("primary_keys", keys) is None:
            for name, key in PRIMARY_KEYS.items():  # the sums below count rows per key
                if name in t:
                    require(dq_primary_key(t[name], name, key))
            log.note("primary_keys", keys, {})

        build("dws_user_summary", lambda: build_user_summary(t["dwd_orders"], t["dwd_order_items"], t["ods_users"], day))
        build("dws_product_summary", lambda: build_product_summary(t["dwd_order_items"]))
        build("dws_date_summary", lambda: build_date_summary(t["dwd_orders"], t["dws_user_summary"]))

        outside = [f"row_count of {n}: {measured[n]['rows']}" for n, (low, high) in (row_bands or {}).items()
                   if not low <= measured[n]["rows"] <= high]
        if outside:
            raise QualityError("; ".join(outside))
        build("ads_daily_kpis", lambda: ads_daily_kpis(t))
        figures = [(table, metric, value) for table, found in measured.items() for metric, value in found.items()]
        overwrite(spark.createDataFrame(figures, "table string, metric string, value bigint").coalesce(1), f"{warehouse}/build_metrics")
        log.clear()
    return t
