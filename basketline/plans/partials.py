"""Summaries kept up to date load by load.

Every load of orders and items leaves four small partial tables, from which its facts are not needed any more:

* ``day_users``: sums per (day, user),
* ``firsts``: the earliest order per user,
* ``baskets``: valid quantity and spend per (user, category),
* ``buyers``: valid sales per (product, user).

Partials of several loads merge by sums, minima and maxima. So adding a load costs work in proportion to its rows, the summaries follow
from the partials, and a load is taken back by dropping its partials.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import valid_order
from ..operators.lookups import looked_up
from ..operators.slices import SHARE, spread, spread_shares
from ..storage import hadoop_path, materialize, path_exists, read_text, write_text
from . import dws

PRODUCT = ["product_id", "product_name", "category", "sub_category", "brand"]

#: Key and merging aggregates of each partial table.
KEYS = {
    "day_users": ["order_date", "user_id"],
    "firsts": ["user_id"],
    "baskets": ["user_id", "category"],
    "buyers": [*PRODUCT, "user_id"],
}
MERGE = {
    "day_users": {"orders": F.sum, "valid": F.sum, "amount": F.sum, "priced": F.sum},
    "firsts": {"first": F.min},
    "baskets": {"spend": F.sum, "quantity": F.sum},
    "buyers": {"price": F.max, "quantity": F.sum, "counted": F.sum, "orders": F.sum, "amount": F.sum, "first_day": F.min,
               "last_day": F.max},
}


def partials_of(orders: DataFrame, items: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The partial tables of one load: raw orders with all their items, and all products.

    An order and its items belong to one load, and ``order_id`` is unique over all loads.
    """
    valid = valid_order(F.col("status"))
    facts = orders.select("order_id", "user_id", "create_time", "total_amount", F.to_date("create_time").alias("order_date"),
                          valid.alias("is_valid_order"))
    counts = F.col("is_valid_order") == 1
    day_users = spread(facts, KEYS["day_users"]).groupBy(*KEYS["day_users"]).agg(
        F.count("order_id").alias("orders"), F.sum("is_valid_order").cast("bigint").alias("valid"),
        F.sum(F.when(counts, F.col("total_amount")).otherwise(0)).cast("decimal(38,2)").alias("amount"),
        F.count(F.when(counts, F.col("total_amount"))).alias("priced"))
    first = F.min(F.struct("create_time", "order_id", "order_date", "is_valid_order")).alias("first")
    firsts = facts.where("user_id IS NOT NULL").groupBy("user_id").agg(first)

    of_order = facts.where(counts).select("order_id", "user_id", F.col("order_date").alias("day"))
    known = products.select(*PRODUCT)
    sold = items.join(of_order, "order_id").join(looked_up(known, products.count()), "product_id", "left")
    sold = materialize(sold.select(*PRODUCT, "user_id", "unit_price", "quantity", "order_id", "amount", "day"), "sold")  # read twice
    quantity = F.sum(F.col("quantity").cast("bigint"))
    bought = spread(sold.select(*KEYS["baskets"], "amount", "quantity"), KEYS["baskets"])
    baskets = bought.groupBy(*KEYS["baskets"]).agg(F.sum("amount").cast("decimal(38,2)").alias("spend"), quantity.alias("quantity"))
    buyers = spread(sold, ["product_id", "user_id"]).groupBy(*KEYS["buyers"]).agg(
        F.max("unit_price").alias("price"), quantity.alias("quantity"), F.count("quantity").alias("counted"),
        F.count("order_id").alias("orders"), F.sum("amount").cast("decimal(38,2)").alias("amount"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return {"day_users": day_users, "firsts": firsts, "baskets": baskets, "buyers": buyers}


def merged(name: str, partials: DataFrame) -> DataFrame:
    """Partials of any number of loads as one, a row per key."""
    parts = [f(c).cast(partials.schema[c].dataType).alias(c) for c, f in MERGE[name].items()]
    if name == "buyers":  # the share stays in the plan, so that sums per product find a product's rows in few tasks
        rows = spread_shares(partials, ["product_id"], "user_id")
        return rows.groupBy(*KEYS[name], SHARE).agg(*parts).drop(SHARE)
    rows = spread(partials, KEYS[name])
    return rows.groupBy(*KEYS[name]).agg(*parts)


class PartialStore:
    """Partial tables of all loads in a folder: a sub-folder for each table and version of a load.

    A numbered list file names the versions that count. Every change writes its tables first and then the next list, by one
    rename, so a change that was cut off changes nothing and is simply made again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _list(self) -> tuple[int, dict[str, str]]:
        """Number of the newest list, and the version of each load in it."""
        if not path_exists(self.spark, f"{self.folder}/lists"):
            return 0, {}
        fs, path = hadoop_path(self.spark, f"{self.folder}/lists")
        numbers = [int(n) for status in fs.listStatus(path) if (n := status.getPath().getName()).isdigit()]
        newest = max(numbers, default=0)
        return newest, json.loads(read_text(self.spark, f"{self.folder}/lists/{newest}") or "{}")

    def _change(self, drop: list[str], add: str | None = None, tables: Mapping[str, DataFrame] | None = None) -> None:
        number, listed = self._list()
        version = uuid.uuid4().hex[:12]
        for name, df in (tables or {}).items():
            df.write.parquet(self._path(name, version))
        old = [listed.pop(load) for load in drop if load in listed]
        if add is not None:
            listed[add] = version
        beside = f"{self.folder}/lists/new-{version}"
        write_text(self.spark, beside, json.dumps(listed))
        fs, source = hadoop_path(self.spark, beside)
        if not fs.rename(source, hadoop_path(self.spark, f"{self.folder}/lists/{number + 1}")[1]):
            raise OSError(f"cannot write list {number + 1} of {self.folder}")
        for gone in old:
            for name in KEYS:
                fs.delete(hadoop_path(self.spark, self._path(name, gone))[1], True)

    def _path(self, name: str, version: str) -> str:
        return f"{self.folder}/{name}/{version}"

    def loads(self) -> list[str]:
        """Names of the loads that count."""
        return sorted(self._list()[1])

    def add(self, load: str, orders: DataFrame, items: DataFrame, products: DataFrame) -> None:
        """Add a load, or replace the one of that name."""
        self._change([load], load, partials_of(orders, items, products))

    def remove(self, load: str) -> None:
        """Take a load back."""
        self._change([load])

    def compact(self, loads: list[str], into: str) -> None:
        """Merge several loads into one, which bounds the number of partials to read. They can no longer be taken back singly."""
        if into in set(self.loads()) - set(loads):
            raise ValueError(f"load {into} exists")
        self._change(loads, into, {name: merged(name, self._read(name, loads)) for name in KEYS})

    def _read(self, name: str, loads: list[str]) -> DataFrame:
        listed = self._list()[1]
        return self.spark.read.parquet(*(self._path(name, listed[load]) for load in loads))

    def tables(self) -> dict[str, DataFrame]:
        """Each partial table merged over all loads. Without a load there is nothing to read, which raises."""
        loads = self.loads()
        if not loads:
            raise ValueError(f"no loads in {self.folder}")
        return {name: merged(name, self._read(name, loads)) for name in KEYS}


def user_summary(t: Mapping[str, DataFrame], users: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """``dws_user_summary`` from merged partials."""
    days = t["day_users"].where("user_id IS NOT NULL")
    base = dws.user_base_of(users, dws.user_totals(days), dws.favorites_of(t["baskets"]), as_of,
                            ["favorite_category", "favorite_category_amount"])
    return dws.user_summary_of(base)


def product_summary(t: Mapping[str, DataFrame]) -> DataFrame:
    """``dws_product_summary`` from merged partials."""
    return dws.product_summary_of(t["buyers"])


def date_summary(t: Mapping[str, DataFrame]) -> DataFrame:
    """``dws_date_summary`` from merged partials."""
    firsts = t["firsts"].where("first.is_valid_order = 1").select(
        F.col("user_id").alias("_user"), F.col("first.order_date").alias("_day"), F.lit(1).alias("new"))
    days = t["day_users"]
    again = days.where("user_id IS NOT NULL").groupBy("user_id").agg(F.sum("orders").alias("n")).where("n >= 2")
    same = (F.col("user_id") == F.col("_user")) & F.col("order_date").eqNullSafe(F.col("_day"))
    per_user = days.join(firsts, same, "left").withColumnsRenamed({"valid": "valid_orders"}).withColumns({
        "active": F.when(F.col("valid_orders") > 0, 1).otherwise(0), "new": F.coalesce("new", F.lit(0))})
    return dws.date_summary_of(per_user, again.select("user_id", F.lit(1).alias("again")))
