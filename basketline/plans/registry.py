"""Every query by name, as a function of the session and a folder of source tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import fixed_values as fv
from ..operators import cohorts
from ..operators.distinct_sets import dense_numbers, distinct_over, member_sets, with_numbers
from ..schemas import PRIMARY_KEYS, SCHEMAS
from ..sources import generate, starschema
from ..sources.checked import read_csv_checked
from ..sources.files import write_csv
from ..sources.starschema import AS_OF, source_table
from ..sources.tables import overwrite, save_as_table, update_partitions
from ..storage import materialize, new_path
from ..streaming.arrivals import load_arrivals, read_arrivals
from ..streaming.incremental import incremental_load, read_loaded
from . import ads, cleaning, dwd, dwd_reports, dws, dws_reports, ods_reports, partials, profiling, quality
from .layers import Layers, layers_of

Query = Callable[[SparkSession, str], DataFrame]

INCREMENTAL_CUT = "1999-01-01 00:00:00"


def _on_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: build(layers_of(spark, folder))


def _tables() -> dict[str, Query]:
    """The table builders themselves, from the layer below."""
    facts = lambda t: (t["dwd_orders"], t["dwd_order_items"], t["ods_users"])
    scored = ("user_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment")
    favorite = ("user_id", "favorite_category", "favorite_category_amount")

    def rfm(t: Layers) -> DataFrame:
        return dws.add_rfm(materialize(dws.build_user_base(*facts(t), AS_OF), "user_base")).select(*scored)

    builders = {
        **{name: (lambda t, name=name: t[name]) for name in starschema.ODS_BUILDERS},
        "dwd_orders": lambda t: dwd.build_dwd_orders(t["ods_orders"], t["ods_users"]),
        "dwd_order_items": lambda t: dwd.build_dwd_order_items(
            t["ods_order_items"], t["ods_orders"], t["ods_products"]),
        "dws_user_base": lambda t: dws.build_user_base(*facts(t), AS_OF),
        "dws_user_base_item_grain": lambda t: dws.build_user_base(*facts(t), AS_OF, "item"),
        "dws_user_rfm": rfm,
        "dws_user_favorite": lambda t: dws.add_favorite(
            t["ods_users"].select("user_id"), t["dwd_order_items"]).select(*favorite),
        "dws_user_summary": lambda t: dws.build_user_summary(*facts(t), AS_OF),
        "dws_user_summary_item_grain": lambda t: dws.build_user_summary(*facts(t), AS_OF, "item"),
        "dws_product_summary": lambda t: dws.build_product_summary(t["dwd_order_items"], t.unique("ods_products")),
        "dws_date_summary": lambda t: dws.build_date_summary(t["dwd_orders"], t["dws_user_summary"]),
        "dwd_orders_stats": lambda t: dwd.dwd_orders_stats(t["dwd_orders"]),
        "dwd_items_stats": lambda t: dwd.dwd_items_stats(t["dwd_order_items"]),
        "dws_user_stats": lambda t: dws.dws_user_stats(t["dws_user_summary"]),
        "dws_product_stats": lambda t: dws.dws_product_stats(t["dws_product_summary"]),
        "dws_date_stats": lambda t: dws.dws_date_stats(t["dws_date_summary"]),
        "ads_daily_kpis": ads.ads_daily_kpis,
    }
    return {name: _on_layers(build) for name, build in builders.items()}


def _reports() -> dict[str, Query]:
    ods = ("ods_table_census", "status_share", "valid_order_amounts", "city_top10", "category_gmv_ods",
           "order_time_span", "orders_with_users")
    facts = ("order_seq", "cumulative_spend", "prev_order", "first_orders", "user_repurchase_cycle", "brand_rank",
             "monthly_gmv", "top_products", "daily_new_users", "retention_d1_d7_d30", "retention_d7", "funnel",
             "repurchase_rate", "repurchase_interval_dist", "repurchase_interval_dist4", "new_vs_returning",
             "dwd_table_census", "valid_vs_invalid", "first_order_city", "category_gmv_dwd", "hourly_orders",
             "level_spend", "join_vs_denorm")
    summaries = ("segment_distribution", "vip_users", "win_back_users", "segment_strategy", "rfm_score_grid",
                 "segment_aov", "dws_table_census", "rfm_score_top20", "repurchase_share", "top_spenders",
                 "top_products_dws", "monthly_rollup")
    found = {
        **{name: getattr(ods_reports, name) for name in ods},
        **{name: getattr(dwd_reports, name) for name in facts},
        **{name: getattr(dws_reports, name) for name in summaries},
        "rfm_levels": lambda t: dwd_reports.rfm_levels(t, AS_OF),
        "active_30d": lambda t: dwd_reports.active_30d(t, AS_OF),
        # Orders of these tables never run over three days in a row; event_streaks does.
        "order_streaks": lambda t: dwd_reports.order_streaks(t, min_days=2),
    }
    return {name: _on_layers(build) for name, build in found.items()}


def _checks() -> dict[str, Query]:
    found = {
        "profile_orders": lambda t: profiling.profile_orders(t["ods_orders"]),
        "value_counts_status": lambda t: profiling.value_counts_status(t["ods_orders"]),
        "value_counts_category": lambda t: profiling.value_counts_category(t["ods_products"]),
        "city_top5": lambda t: profiling.city_top5(t["ods_users"]),
        "describe_price": lambda t: profiling.describe_price(t["ods_products"]),
        "dq_row_bands": lambda t: quality.dq_row_bands(t),
        "dq_orders": lambda t: quality.dq_orders(t["ods_orders"]),
        "dq_first_orders": lambda t: quality.dq_first_orders(t["dwd_orders"]),
        "dq_primary_keys": lambda t: quality.dq_primary_keys(t, PRIMARY_KEYS, together=t.buckets),
        "dq_status_domain": lambda t: quality.dq_status_domain(t["ods_orders"]),
        "dq_orphans": lambda t: quality.dq_orphans(
            t["ods_orders"], t["ods_order_items"], t["ods_users"], t["ods_products"]),
        "dq_header_vs_items": lambda t: quality.dq_header_vs_items(t["ods_orders"], t["ods_order_items"]),
        "dq_text_widths": lambda t: quality.dq_text_widths(t["ods_users"], "ods_users"),
        "clean_orders": lambda t: cleaning.clean_orders(t["ods_orders"]),
        "quarantined_orders": lambda t: cleaning.quarantined_orders(t["ods_orders"]),
    }
    queries = {name: _on_layers(build) for name, build in found.items()}
    # The raw line items do repeat a product within an order; the mapped items do not.
    queries["dq_pk_items"] = lambda spark, folder: quality.dq_primary_key(
        source_table(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_partkey"])
    return queries


def _event_days(spark: SparkSession, folder: str) -> DataFrame:
    return source_table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"))


def _events() -> dict[str, Query]:
    """The user operators over the event log, which has long runs of days."""
    kind = lambda name: F.col("event_type") == name
    return {
        "event_streaks": lambda spark, folder: cohorts.streaks(
            _event_days(spark, folder), "user_id", "day", 3, distinct_users=True),
        "event_retention": lambda spark, folder: cohorts.retention(_event_days(spark, folder), "user_id", "day"),
        "event_funnel": lambda spark, folder: cohorts.funnel(
            source_table(spark, folder, "events"), "user_id",
            {"visitors": F.lit(True), "viewed": kind("view"), "clicked": kind("click"), "purchased": kind("purchase")}),
    }


def _order_number() -> Column:
    return F.substring("order_id", 2, 20).cast("bigint")


def _loaded(rows: DataFrame, load: Column) -> DataFrame:
    return rows.groupBy(load.alias("load_number")).agg(
        F.count(F.lit(1)).alias("loaded_rows"),
        F.min("create_time").alias("earliest"), F.max("create_time").alias("latest"),
        F.sum("total_amount").cast("decimal(18,2)").alias("amount"),
    )


def _late() -> Column:
    """One order in fifty arrives after its time."""
    return _order_number() % 50 == 0


def incremental_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Load the orders in two goes, as they arrive: up to a date but for late ones, then the rest with the late ones."""
    orders = layers_of(spark, folder)["ods_orders"]
    landing, target, state = (new_path(spark, name) for name in ("landing", "orders_by_load", "load_state"))
    first = (F.col("create_time") <= F.lit(INCREMENTAL_CUT).cast("timestamp_ntz")) & ~_late()
    for load, arrived in enumerate((orders.where(first), orders.where(~first)), 1):
        arrived.write.mode("append").parquet(landing)
        load_arrivals(spark, landing, target, state, orders.schema, load)
    return _loaded(read_arrivals(spark, target, orders.schema), F.col("load_number"))


def incremental_orders_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """Load the orders in two goes by the time of the last load, late ones by their key, and sum up what each stored."""
    orders = layers_of(spark, folder)["ods_orders"]
    target, state = new_path(spark, "orders_by_mark"), new_path(spark, "mark_state")
    incremental_load(spark, orders.where(~_late()), target, state, "orders", "create_time", upto=INCREMENTAL_CUT)
    incremental_load(spark, orders, target, state, "orders", "create_time", key=["order_id"])
    return _loaded(read_loaded(spark, target), F.when(F.col("load_after") != "0001-01-01-00-00-00", 2).otherwise(1))


def dq_rejected_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV, some with text where a number belongs, and checked on the way back in."""
    orders, number = layers_of(spark, folder)["ods_orders"], _order_number()
    path = new_path(spark, "damaged_orders")
    write_csv(orders.withColumns({
        "total_amount": F.when(number % 101 == 7, "abc").otherwise(F.col("total_amount").cast("string")),
        "item_count": F.when(number % 103 == 5, "two").otherwise(F.col("item_count").cast("string")),
    }), path)
    checked = read_csv_checked(spark, path, SCHEMAS["ods_orders"])
    return quality.dq_rejected_rows(checked.loaded, checked.rejected, "ods_orders")


def dwd_orders_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The figures of the order facts as the job that writes them reports them."""
    t, seen = layers_of(spark, folder), Observation("dwd_orders")
    facts = dwd.with_order_month(dwd.build_dwd_orders(t["ods_orders"], t["ods_users"]), "create_time")
    overwrite(facts, new_path(spark, "dwd_orders"), "order_month", seen, dwd.dwd_orders_metrics())
    figures = seen.get
    return spark.createDataFrame([tuple(figures[n] for n in ("total", "valid", "first"))], "total bigint, valid bigint, first bigint")


def dwd_order_items_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The item facts from raw tables bucketed by order, so that items meet their orders without a shuffle."""
    t, buckets = layers_of(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = {}
    for name in ("ods_orders", "ods_order_items"):
        path = new_path(spark, f"bucketed_{name}")
        table = path.rsplit("/", 1)[-1].replace("-", "_")
        save_as_table(t[name], table, "order_id", buckets, path)
        bucketed[name] = spark.table(table)
    return dwd.build_dwd_order_items(bucketed["ods_order_items"], bucketed["ods_orders"], t["ods_products"])


def updated_order_status(spark: SparkSession, folder: str) -> DataFrame:
    """Some orders of 1998 are refunded in the stored facts, whose other months stay; orders and amount by month and state."""
    path = new_path(spark, "updated_orders")
    facts = layers_of(spark, folder)["dwd_orders"]
    overwrite(facts, path, "order_month")
    refunded = facts.where((F.year("create_time") == 1998) & (_order_number() % 97 == 0)).select("order_id", F.lit("refunded").alias("status"))
    update_partitions(spark, path, refunded, "order_id", "order_month")
    return spark.read.parquet(path).groupBy("order_month", "status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").cast("decimal(18,2)").alias("amount"))


N_LOADS = 3


def _by_loads(summary: Callable[[SparkSession, str, dict[str, DataFrame]], DataFrame]) -> Query:
    """A summary from the partials of loads that each bring a share of the orders of all days."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = layers_of(spark, folder)
        key = (id(spark._jvm), spark.sparkContext.applicationId, folder, id(t))
        if key not in _STORES:
            store = partials.PartialStore(spark, new_path(spark, "partials"))
            for load in range(N_LOADS):
                mine = F.pmod(_order_number(), F.lit(N_LOADS)) == load
                store.add(str(load), t["ods_orders"].where(mine), t["ods_order_items"].where(mine), t["ods_products"])
            _STORES[key] = store
        return summary(spark, folder, _STORES[key].tables())

    return run


_STORES: dict[tuple, partials.PartialStore] = {}


def active_users_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users with an order per day, month, quarter and year, all from the daily sets."""
    orders = layers_of(spark, folder)["dwd_orders"].select("user_id", "order_date")
    numbers = dense_numbers(layers_of(spark, folder)["ods_users"], "user_id")
    daily = materialize(member_sets(with_numbers(orders, numbers, "user_id"), ["order_date"]), "daily_users")
    day = F.col("order_date")
    periods = {"day": day, "month": F.trunc(day, "month"), "quarter": F.trunc(day, "quarter"), "year": F.trunc(day, "year")}
    parts = [distinct_over(daily, [first.alias("first_day")], "users").select(F.lit(name).alias("period"), "first_day", "users")
             for name, first in periods.items()]
    return reduce(DataFrame.union, parts)


def _numbers(spark: SparkSession, folder: str, table: str, key: str) -> DataFrame:
    """The row numbers of a generated table: one per row of a source table."""
    return source_table(spark, folder, table).select((F.col(key) + 1).alias("n"))


def generated_users(spark: SparkSession, folder: str) -> DataFrame:
    users = generate.gen_users(_numbers(spark, folder, "customer", "c_custkey"), as_of=AS_OF)
    inside = (
        F.col("gender").isin(*fv.GENDERS) & F.col("city").isin(*fv.CITIES) & F.col("level").isin(*fv.USER_LEVELS)
        & F.col("age").between(min(fv.AGE_CENTRES) - 2, max(fv.AGE_CENTRES) + 2)
        & F.datediff(F.lit(str(AS_OF)).cast("date"), "register_date").between(0, generate.REGISTERED_WITHIN_DAYS)
    )
    return users.agg(
        F.count(F.lit(1)).alias("users"), F.count_distinct("user_id").alias("distinct_ids"),
        F.count_if(~inside).alias("outside_domain"),
    )


def generated_products(spark: SparkSession, folder: str) -> DataFrame:
    products = generate.gen_products(_numbers(spark, folder, "part", "p_partkey"), as_of=AS_OF)
    inside = F.lit(False)
    for name, (subs, brands, (low, high)) in fv.PRODUCT_CATEGORIES.items():
        inside = inside | (
            (F.col("category") == name) & F.col("sub_category").isin(*subs) & F.col("brand").isin(*brands)
            & F.col("price").between(low, high)
        )
    inside = inside & F.col("stock").between(0, generate.MAX_STOCK)
    return products.agg(
        F.count(F.lit(1)).alias("products"), F.count_distinct("product_id").alias("distinct_ids"),
        F.count_if(~inside).alias("outside_range"),
    )


N_GENERATED_USERS, N_GENERATED_PRODUCTS = 100_000, 5_000


def generated_orders(spark: SparkSession, folder: str) -> DataFrame:
    ids = _numbers(spark, folder, "orders", "o_orderkey")
    orders = generate.gen_orders(ids, N_GENERATED_USERS, N_GENERATED_PRODUCTS, as_of=AS_OF)
    items = generate.gen_order_items(ids, N_GENERATED_PRODUCTS).groupBy("order_id").agg(
        F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    minutes = F.timestamp_diff("MINUTE", F.col("create_time"), F.col("pay_time"))
    paid_well = F.when(F.col("status") == "cancelled", F.col("pay_time").isNull()).otherwise(
        minutes.between(1, generate.PAID_WITHIN_MINUTES))
    return orders.join(items, "order_id", "left").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("n").alias("orders_with_items"),
        F.count_if(~F.col("total_amount").eqNullSafe(F.col("amount"))).alias("amount_differs"),
        F.count_if(~F.col("item_count").eqNullSafe(F.col("n"))).alias("count_differs"),
        F.count_if(~F.coalesce(paid_well, F.lit(False))).alias("bad_pay_time"),
    )


def generated_order_items(spark: SparkSession, folder: str) -> DataFrame:
    ids = _numbers(spark, folder, "orders", "o_orderkey")
    items = generate.gen_order_items(ids, N_GENERATED_PRODUCTS)
    price = F.col("unit_price")
    per_order = items.groupBy("order_id").agg(
        (F.count(F.lit(1)) - F.count_distinct("product_id")).alias("duplicates"),
        F.count_if(~price.between(fv.ITEM_PRICE_MIN, fv.ITEM_PRICE_MAX)).alias("outside"),
        F.count_if(F.col("amount") != price * F.col("quantity")).alias("wrong"),
    )
    return per_order.agg(
        F.count(F.lit(1)).alias("orders"), F.sum("duplicates").alias("duplicate_products"),
        F.sum("outside").alias("outside_price_range"), F.sum("wrong").alias("wrong_amount"),
    )


def all_queries() -> dict[str, Query]:
    return {
        **_tables(), **_reports(), **_checks(), **_events(),
        "incremental_orders": incremental_orders,
        "incremental_orders_by_time": incremental_orders_by_time,
        "dq_rejected_orders": dq_rejected_orders,
        "dwd_orders_observed": dwd_orders_observed,
        "dwd_order_items_bucketed": dwd_order_items_bucketed,
        "updated_order_status": updated_order_status,
        "dws_user_summary_by_loads": _by_loads(
            lambda spark, folder, t: partials.user_summary(t, layers_of(spark, folder)["ods_users"], AS_OF)),
        "dws_product_summary_by_loads": _by_loads(lambda spark, folder, t: partials.product_summary(t)),
        "dws_date_summary_by_loads": _by_loads(lambda spark, folder, t: partials.date_summary(t)),
        "active_users_rollup": active_users_rollup,
        "gen_users": generated_users,
        "gen_products": generated_products,
        "gen_orders": generated_orders,
        "gen_order_items": generated_order_items,
    }
