"""Synthetic raw tables as distributed jobs.

Every value is a hash of the row's number and a seed: any partitioning, any retry and any
cluster size yield the same rows. Each function takes a frame with a ``n`` column (1, 2,
…), from :func:`numbers` or from an existing table.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.dates import as_of_date
from ..functions.draws import choice, normal, uniform, uniform_int, weighted_choice, with_distinct_picks
from ..functions.rules import clamp, padded_id
from ..schemas import conform
from .files import write_csv

# Seeds of the three generators, and how far back dates reach.
SEED_USERS, SEED_PRODUCTS, SEED_ORDERS = 42, 43, 44
REGISTERED_WITHIN_DAYS = 730
ORDERED_WITHIN_DAYS = 365
MAX_STOCK = 10_000
PAID_WITHIN_MINUTES = 30


def numbers(spark: SparkSession, count: int) -> DataFrame:
    """The numbers 1..``count`` as column ``n``, produced by the executors."""
    return spark.range(1, count + 1).withColumnRenamed("id", "n")


def gen_users(ids: DataFrame, seed: int = SEED_USERS, as_of: dt.date | str | None = None) -> DataFrame:
    n = F.col("n")
    u = lambda purpose: uniform(seed, purpose, n)
    age = weighted_choice(u("age"), fv.AGE_CENTRES, fv.AGE_WEIGHTS) + uniform_int(u("age spread"), -2, 2)
    users = ids.select(
        padded_id("U", n, 8).alias("user_id"),
        F.concat(F.lit("user_"), F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), n)), 1, 10)).alias("username"),
        choice(u("gender"), fv.GENDERS).alias("gender"),
        age.alias("age"),
        choice(u("city"), fv.CITIES).alias("city"),
        padded_id("1", F.floor(u("phone") * 10_000_000_000), 10).alias("phone"),
        weighted_choice(u("level"), fv.USER_LEVELS, fv.USER_LEVEL_WEIGHTS).alias("level"),
        F.date_sub(as_of_date(as_of), uniform_int(u("registered"), 0, REGISTERED_WITHIN_DAYS)).alias("register_date"),
    )
    return conform(users, "ods_users")


def _category_table() -> Column:
    """The product categories as one array literal."""
    return F.array(*(
        F.struct(
            F.lit(name).alias("category"),
            F.array(*map(F.lit, subs)).alias("subs"),
            F.array(*map(F.lit, brands)).alias("brands"),
            F.lit(math.log(low)).alias("log_low"),
            F.lit(math.log(high)).alias("log_high"),
        )
        for name, (subs, brands, (low, high)) in fv.PRODUCT_CATEGORIES.items()
    ))


def gen_products(ids: DataFrame, seed: int = SEED_PRODUCTS, as_of: dt.date | str | None = None) -> DataFrame:
    """Prices are uniform in their logarithm within the range of the category."""
    n = F.col("n")
    u = lambda purpose: uniform(seed, purpose, n)
    kind = F.element_at(_category_table(), uniform_int(u("category"), 1, len(fv.PRODUCT_CATEGORIES)))
    pick = lambda options, purpose: F.element_at(options, uniform_int(u(purpose), F.lit(1), F.size(options)))
    drawn = ids.select(n, kind.alias("kind")).select(
        n,
        F.col("kind.category").alias("category"),
        pick(F.col("kind.subs"), "sub category").alias("sub_category"),
        pick(F.col("kind.brands"), "brand").alias("brand"),
        F.exp(F.col("kind.log_low") + u("price") * (F.col("kind.log_high") - F.col("kind.log_low"))).alias("price"),
    )
    products = drawn.select(
        padded_id("P", n, 6).alias("product_id"),
        F.concat_ws(" ", "brand", "sub_category", F.substring(F.md5(n.cast("string")), 1, 4)).alias("product_name"),
        "category", "sub_category",
        F.round(F.col("price"), 2).alias("price"),
        "brand",
        uniform_int(u("stock"), 0, MAX_STOCK).alias("stock"),
        F.date_sub(as_of_date(as_of), uniform_int(u("on shelf"), 0, REGISTERED_WITHIN_DAYS)).alias("on_shelf_date"),
    )
    return conform(products, "ods_products")


def _item_count(seed: int) -> Column:
    return weighted_choice(uniform(seed, "items", F.col("n")), fv.ITEM_COUNTS, fv.ITEM_COUNT_WEIGHTS)


def _with_products(ids: DataFrame, n_products: int, seed: int) -> DataFrame:
    """``n``, the number of items ``k`` and the array of their products."""
    counted = ids.select("n", _item_count(seed).alias("k"))
    return with_distinct_picks(
        counted, "products", seed, "product", F.col("n"), F.col("k"), n_products, max(fv.ITEM_COUNTS)
    )


def _quantity(seed: int, product: Column) -> Column:
    return weighted_choice(uniform(seed, "quantity", F.col("n"), product), fv.QUANTITIES, fv.QUANTITY_WEIGHTS)


def _unit_price(seed: int, product: Column) -> Column:
    drawn = F.exp(fv.ITEM_PRICE_LOG_MEAN + fv.ITEM_PRICE_LOG_SD * normal(seed, "price", F.col("n"), product))
    return clamp(F.round(drawn, 2), fv.ITEM_PRICE_MIN, fv.ITEM_PRICE_MAX).cast("decimal(10,2)")


def gen_order_items(ids: DataFrame, n_products: int, seed: int = SEED_ORDERS) -> DataFrame:
    """One to five different products per order, with log-normal prices."""
    # The outer form keeps the optimizer from adding a filter that repeats all draws.
    lines = _with_products(ids, n_products, seed).select("n", F.explode_outer("products").alias("product"))
    product = F.col("product")
    items = lines.select(
        padded_id("O", F.col("n"), 9).alias("order_id"),
        padded_id("P", product, 6).alias("product_id"),
        _quantity(seed, product).alias("quantity"),
        _unit_price(seed, product).alias("unit_price"),
    ).withColumn("amount", F.col("unit_price") * F.col("quantity"))
    return conform(items, "ods_order_items")


def gen_orders(
    ids: DataFrame, n_users: int, n_products: int, seed: int = SEED_ORDERS, as_of: dt.date | str | None = None
) -> DataFrame:
    """Orders whose amount is the sum of the items that :func:`gen_order_items` gives them.

    The items are drawn again inside the order's row, so the two tables agree without a
    join.
    """
    n = F.col("n")
    u = lambda purpose: uniform(seed, purpose, n)
    amount = lambda product: _unit_price(seed, product) * _quantity(seed, product)
    total = F.aggregate(
        "products", F.lit(0).cast("decimal(12,2)"), lambda sum_, product: (sum_ + amount(product)).cast("decimal(12,2)")
    )
    at_noon = as_of_date(as_of).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(12))
    created = at_noon - F.make_dt_interval(
        days=uniform_int(u("days ago"), 0, ORDERED_WITHIN_DAYS), hours=uniform_int(u("hours ago"), 0, 23)
    )
    paid = F.col("create_time") + F.make_dt_interval(mins=uniform_int(u("pay delay"), 1, PAID_WITHIN_MINUTES))
    orders = _with_products(ids, n_products, seed).select(
        n,
        padded_id("O", n, 9).alias("order_id"),
        padded_id("U", uniform_int(u("user"), 1, n_users), 8).alias("user_id"),
        total.cast("decimal(12,2)").alias("total_amount"),
        weighted_choice(u("status"), fv.ORDER_STATUSES, fv.STATUS_WEIGHTS).alias("status"),
        F.col("k").alias("item_count"),
        created.alias("create_time"),
    ).withColumn("pay_time", F.when(F.col("status") != "cancelled", paid))
    return conform(orders, "ods_orders")


def generate_sources(
    spark: SparkSession, folder: str, n_users: int, n_products: int, n_orders: int,
    as_of: dt.date | str | None = None,
) -> None:
    """Write the four raw CSV tables below ``folder``."""
    folder, orders = folder.rstrip("/"), numbers(spark, n_orders)
    write_csv(gen_users(numbers(spark, n_users), as_of=as_of), f"{folder}/users.csv")
    write_csv(gen_products(numbers(spark, n_products), as_of=as_of), f"{folder}/products.csv")
    write_csv(gen_orders(orders, n_users, n_products, as_of=as_of), f"{folder}/orders.csv")
    write_csv(gen_order_items(orders, n_products), f"{folder}/order_items.csv")
