"""The tables that reports read, built on first use and stored.

Raw, fact and summary tables are written once per application and source folder, as the
layers of a warehouse are, so a report scans a stored table instead of repeating the joins
under it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PRIMARY_KEYS
from ..sources import starschema
from ..storage import fingerprint, materialize
from .dwd import build_dwd_order_items, build_dwd_orders, with_order_month
from .dws import build_date_summary, build_product_summary, build_user_summary
from .quality import dq_primary_key, require


#: The time that facts are partitioned by, by month.
FACT_TIMES = {"dwd_orders": "create_time", "dwd_order_items": "order_time"}

CODEC = "zstd"  # layers are written once and read often


class Layers(Mapping):
    """Table name -> DataFrame; asking for a table builds what it depends on.

    Raw tables are given as frames, used as they are, or as builders, whose result is stored and must have unique keys.
    ``by_month`` adds the order month to the facts and partitions them by it, as the pipeline does. ``buckets`` gives, for
    built raw tables, the key column and the number of partitions by it in which the builder leaves them: they are stored so.
    """

    def __init__(self, ods: Mapping[str, DataFrame | Callable[[], DataFrame]], as_of: dt.date | str | None,
                 store: bool = True, by_month: bool = False, buckets: Mapping[str, tuple[str, int]] | None = None):
        self.as_of = as_of
        self.buckets = dict(buckets or {}) if store else {}
        self._unchecked: dict[str, DataFrame] = {}
        self._unique: set[str] = set()
        self._checked: dict[str, list] = {}
        self._tables = {name: df for name, df in ods.items() if not callable(df)}
        self._store = store
        self._by_month = by_month
        self._builders: dict[str, Callable[[], DataFrame]] = {
            **{name: build for name, build in ods.items() if callable(build)},
            "dwd_orders": lambda: build_dwd_orders(self["ods_orders"], self["ods_users"]),
            "dwd_order_items": lambda: build_dwd_order_items(
                self["ods_order_items"], self["ods_orders"], self["ods_products"]
            ),
            "dws_user_summary": lambda: build_user_summary(
                self["dwd_orders"], self["dwd_order_items"], self["ods_users"], self.as_of
            ),
            "dws_product_summary": lambda: build_product_summary(
                self["dwd_order_items"], self.unique("ods_products")),
            "dws_date_summary": lambda: build_date_summary(self["dwd_orders"], self["dws_user_summary"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.unchecked(name)
            if self._store and name.startswith("ods_"):  # facts and sums count rows per key
                require(self._key_checks(name))
                self._unique.add(name)
        return self._tables[name]

    def unique(self, name: str) -> DataFrame | None:
        """A raw table whose keys were checked and found unique; none if they were not."""
        table = self[name]
        return table if name in self._unique else None

    def _key_checks(self, name: str) -> list:
        """The checks of a raw table's keys, made once."""
        if name not in self._checked:
            self._checked[name] = dq_primary_key(self.unchecked(name), name, PRIMARY_KEYS[name], name in self.buckets).collect()
        return self._checked[name]

    def keys_unique(self, name: str) -> bool:
        """Whether the keys of a raw table neither repeat nor are missing; does not raise."""
        return all(r.status == "PASS" for r in self._key_checks(name))

    def unchecked(self, name: str) -> DataFrame:
        """A table whose keys may repeat or be missing, for the builders of other raw tables."""
        if name in self._tables:
            return self._tables[name]
        if name not in self._unchecked:
            table = self._builders[name]()
            month = None
            if self._by_month and name in FACT_TIMES:
                table, month = with_order_month(table, FACT_TIMES[name]), "order_month"
            self._unchecked[name] = materialize(table, name, month, self.buckets.get(name), CODEC) if self._store else table
        return self._unchecked[name]

    def __iter__(self):
        return iter([*(n for n in self._tables if n not in self._builders), *self._builders])

    def __len__(self) -> int:
        return len(list(iter(self)))


_LAYERS: dict[tuple, Layers] = {}


def layers_of(spark: SparkSession, folder: str) -> Layers:
    """The layers over a star schema folder; rebuilt when a source file changes."""
    sources = ("customer", "nation", "part", "orders", "lineitem")
    state = tuple(fingerprint(spark, f"{folder}/{name}.parquet") for name in sources)
    key = (id(spark._jvm), spark.sparkContext.applicationId, folder, state)
    if key not in _LAYERS:
        ods = {name: partial(build, spark, folder) for name, build in starschema.ODS_BUILDERS.items()}
        ods["ods_orders"] = lambda: starschema.orders(
            spark, folder, layers.unchecked("ods_order_items"), layers.keys_unique("ods_order_items"))
        by_order = ("order_id", starschema.order_tasks(spark, folder))
        layers = Layers(ods, starschema.AS_OF, by_month=True, buckets={"ods_orders": by_order, "ods_order_items": by_order})
        _LAYERS[key] = layers
    return _LAYERS[key]
