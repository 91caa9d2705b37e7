"""Summary tables per user, product and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import as_of_date, average_gap, iso_weekday
from ..functions.money import money, ratio
from ..functions.rules import rfm_score, rfm_segment
from ..operators.lookups import looked_up
from ..operators.ranking import ntile_scores, rank_within
from ..operators.slices import SHARE, spread, spread_shares
from ..schemas import conform
from ..storage import materialize


PRODUCT_ATTRIBUTES = ("product_name", "category", "sub_category", "brand")


def _valid() -> Column:
    return F.col("is_valid_order") == 1


def _quantity() -> Column:
    return F.sum(F.col("quantity").cast("bigint")).alias("total_quantity")


def build_user_base(
    dwd_orders: DataFrame, items: DataFrame, users: DataFrame, as_of: dt.date | str | None = None,
    grain: str = "order", favorite: bool = False,
) -> DataFrame:
    """Per user, also without orders: counts, amounts, dates, gaps.

    ``grain="order"`` counts each valid order once. ``grain="item"`` counts it once per
    item it holds (at least once), as a join of orders to items before the sums would.
    Dates, active days and the repurchase flag cover orders of any status. ``favorite``
    adds the favourite category from the same pass over the items.

    ``order_id`` must be unique in ``dwd_orders`` and ``is_valid_order`` of the items must
    be that of their order.
    """
    if grain not in ("order", "item"):
        raise ValueError(f"unknown grain: {grain}")
    orders = dwd_orders.select("order_id", "user_id", "order_date", "total_amount", "is_valid_order")
    weight = F.lit(1)
    if grain == "item":
        per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
        orders = orders.join(per_order, "order_id", "left")
        weight = F.greatest(F.coalesce("n_items", F.lit(1)), F.lit(1))

    # First to (user, day): active days become a plain count, and a user with very many
    # orders is spread over days before meeting in one task.
    days = spread(orders.where("user_id IS NOT NULL"), ["user_id", "order_date"], dwd_orders.count())
    by_day = days.groupBy("user_id", "order_date").agg(
        F.count("order_id").alias("orders"),
        F.sum(F.when(_valid(), weight).otherwise(0)).alias("valid"),
        F.sum(F.when(_valid(), F.col("total_amount") * weight).otherwise(0)).alias("amount"),
        F.sum(F.when(_valid() & F.col("total_amount").isNotNull(), weight).otherwise(0)).alias("priced"),
    )
    if favorite:
        item_part, extra = _favorites(items), ["favorite_category", "favorite_category_amount"]
    else:
        item_part, extra = items.where(_valid()).groupBy("user_id").agg(_quantity()), []
    return user_base_of(users, user_totals(by_day), item_part, as_of, extra)


def user_totals(by_day: DataFrame) -> DataFrame:
    """Per user, from one row per (user, day): counts, amounts, first and last day, days."""
    return by_day.groupBy("user_id").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("valid").alias("valid_orders"),
        F.sum("amount").alias("amount"),
        F.sum("priced").alias("priced"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count("order_date").alias("active_days"),
    )


def user_base_of(
    users: DataFrame, by_user: DataFrame, item_part: DataFrame, as_of: dt.date | str | None, extra: list[str],
) -> DataFrame:
    """All users with their totals, quantities and the columns ``extra`` of ``item_part``."""
    zero = F.lit(0)
    first, last = F.col("first_order_date"), F.col("last_order_date")
    return (
        users.select("user_id", "username", "city", F.col("level").alias("user_level"))
        .join(by_user, "user_id", "left")
        .join(item_part, "user_id", "left")
        .select(
            "user_id", "username", "city", "user_level",
            F.coalesce("total_orders", zero).alias("total_orders"),
            F.coalesce("valid_orders", zero).alias("valid_orders"),
            F.coalesce("total_quantity", zero).alias("total_quantity"),
            money(F.when(F.col("total_orders").isNull(), zero).otherwise(F.col("amount"))).alias("total_amount"),
            first, last,
            F.datediff(as_of_date(as_of), last).alias("days_since_last"),
            F.coalesce("active_days", zero).alias("active_days"),
            ratio(F.col("amount"), F.col("priced")).alias("avg_order_amount"),
            average_gap(first, last, F.col("active_days")).alias("avg_days_between"),
            F.when(F.col("total_orders") >= 2, 1).otherwise(0).alias("is_repurchase"),
            *extra,
        )
    )


def _favorites(items: DataFrame) -> DataFrame:
    """Per user: quantity of valid items, category of highest valid spend, that spend.

    Equal spends go to the first category in order, an unknown one before all.
    """
    quantity = F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    bought = spread(items.where(_valid()).select("user_id", "category", "amount", "quantity"), ["user_id", "category"])
    return favorites_of(bought.groupBy("user_id", "category").agg(F.sum("amount").alias("spend"), quantity))


def favorites_of(spend: DataFrame) -> DataFrame:
    """:func:`_favorites` from one row per (user, category)."""
    best = F.min(F.struct(F.col("spend").isNull(), (-F.col("spend")).alias("minus"), F.col("category")))
    return spend.groupBy("user_id").agg(best.alias("best"), F.sum("quantity").alias("total_quantity")).select(
        "user_id",
        "total_quantity",
        F.col("best.category").alias("favorite_category"),
        money(-F.col("best.minus")).alias("favorite_category_amount"),
    )


def add_favorite(base: DataFrame, items: DataFrame) -> DataFrame:
    """Add each user's category of highest valid spend and that spend."""
    return base.join(_favorites(items).drop("total_quantity"), "user_id", "left")


def add_rfm(base: DataFrame) -> DataFrame:
    """Add scores 1–5 over the users with a valid order, their digits, and the segment.

    Recent, frequent and high-spending users score high; ties go by ``user_id``.
    ``base`` should be a stored table: it is read once to place the cut-offs, then once to
    score.
    """
    scored = ntile_scores(
        base,
        {
            "r_score": -F.col("days_since_last"),
            "f_score": F.col("valid_orders"),
            "m_score": F.col("total_amount"),
        },
        "user_id", 5, where=F.col("valid_orders") > 0, nulls_last=["r_score"],  # as a descending sort places them
    )
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return scored.withColumns({"rfm_score": rfm_score(*scores), "rfm_segment": rfm_segment(*scores)})


def build_user_summary(
    dwd_orders: DataFrame, items: DataFrame, users: DataFrame, as_of: dt.date | str | None = None,
    grain: str = "order",
) -> DataFrame:
    """The per-user summary: base measures, favourite category, RFM."""
    return user_summary_of(build_user_base(dwd_orders, items, users, as_of, grain, favorite=True))


def user_summary_of(base: DataFrame) -> DataFrame:
    """Scores and segments added to the base with favourite categories."""
    return conform(add_rfm(materialize(base, "user_base")), "dws_user_summary")


def build_product_summary(items: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Per product with a valid sale: volumes, buyers, dates, averages, rank in category.

    ``(order_id, product_id)`` must be unique and product attributes the same in all rows
    of a product. Rows are reduced to (product, user) first, so distinct users become a
    plain count and a best-seller is spread over its buyers. ``price`` is the highest
    price paid.

    With ``products``, one row per product and the table the attributes of the items come from, they are taken from there
    after the sums and are not moved with every item.
    """
    attributes = ["product_id", *(PRODUCT_ATTRIBUTES if products is None else [])]
    sold = items.where(_valid()).select(
        *attributes, "user_id", "unit_price", "quantity", F.when(F.col("order_id").isNotNull(), 1).alias("ordered"), "amount",
        F.to_date("order_time").alias("day"))
    per_buyer = spread_shares(sold, ["product_id"], "user_id").groupBy(*attributes, "user_id", SHARE).agg(
        F.max("unit_price").alias("price"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.count("quantity").alias("counted"),
        F.count("ordered").alias("orders"),
        F.sum("amount").alias("amount"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )
    return product_summary_of(per_buyer, products)


def product_summary_of(per_buyer: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """:func:`build_product_summary` from one row per (product, user), with the attributes unless ``products`` has them."""
    base = per_buyer.groupBy("product_id", *(PRODUCT_ATTRIBUTES if products is None else [])).agg(
        F.max("price").alias("price"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("orders").alias("total_orders"),
        F.count("user_id").alias("total_users"),
        money(F.sum("amount")).alias("total_amount"),
        F.min("first_day").alias("first_sale_date"),
        F.max("last_day").alias("last_sale_date"),
        ratio(F.sum("quantity"), F.sum("counted")).alias("avg_quantity_per_order"),
        ratio(F.sum("quantity"), F.count("user_id")).alias("avg_user_quantity"),
    )
    if products is not None:
        base = base.join(looked_up(products.select("product_id", *PRODUCT_ATTRIBUTES), products.count()), "product_id", "left")
    stored = looked_up(materialize(base, "product_base"))
    return conform(rank_within(stored, ["category"], "total_quantity", "category_rank"), "dws_product_summary")


def build_date_summary(dwd_orders: DataFrame, user_summary: DataFrame) -> DataFrame:
    """Per day with an order: active, new and repurchasing users, orders, amounts.

    ``order_id`` must be unique. Rows are reduced to (day, user) first, so that distinct
    users become plain sums. Users who ever ordered twice count as repurchasing on all
    their days.
    """
    orders = dwd_orders.select("order_date", "user_id", "order_id", "is_valid_order", "is_first_order", "total_amount")
    per_user = spread(orders, ["user_id", "order_date"]).groupBy("order_date", "user_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("is_valid_order").alias("valid_orders"),
        F.sum(F.when(_valid(), F.col("total_amount")).otherwise(0)).alias("amount"),
        F.count(F.when(_valid(), F.col("total_amount"))).alias("priced"),
        F.max("is_valid_order").alias("active"),
        F.max(F.col("is_valid_order") * F.col("is_first_order")).alias("new"),
    )
    again = user_summary.where("is_repurchase = 1").select("user_id", F.lit(1).alias("again"))
    return date_summary_of(per_user, looked_up(again, user_summary.count()))


def date_summary_of(per_user: DataFrame, repurchasing: DataFrame) -> DataFrame:
    """:func:`build_date_summary` from one row per (day, user), and the users who ordered twice."""
    known = F.col("user_id").isNotNull()
    flag = lambda condition: F.sum(F.when(known & condition, 1).otherwise(0))
    active = F.col("active") == 1
    by_day = per_user.join(repurchasing, "user_id", "left").groupBy(F.col("order_date").alias("date")).agg(
        flag(active).alias("dau"),
        flag(F.col("new") == 1).alias("new_users"),
        flag(active & (F.col("again") == 1)).alias("repurchase_users"),
        F.count("user_id").alias("total_active_users"),
        F.sum("orders").alias("total_orders"),
        F.sum("valid_orders").alias("valid_orders"),
        F.sum("amount").alias("amount"),
        F.sum("priced").alias("priced"),
    )
    day = F.col("date")
    summary = by_day.withColumns({
        "total_amount": money(F.col("amount")),
        "avg_order_value": ratio(F.col("amount"), F.col("priced")),
        "avg_user_amount": ratio(F.col("amount"), F.col("dau")),
        "year": F.year(day), "month": F.month(day), "weekday": iso_weekday(day),
    })
    return conform(summary, "dws_date_summary")


def dws_user_stats(user_summary: DataFrame) -> DataFrame:
    """Users, repurchasing users and number of segments of a finished build."""
    by_segment = user_summary.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("users"), F.sum("is_repurchase").alias("again")
    )
    return by_segment.agg(
        F.sum("users").alias("users"), F.sum("again").alias("repurchase"), F.count("rfm_segment").alias("segments")
    )


def dws_product_stats(product_summary: DataFrame) -> DataFrame:
    return product_summary.agg(F.count(F.lit(1)).alias("products"), money(F.sum("total_amount")).alias("gmv"))


def dws_date_stats(date_summary: DataFrame) -> DataFrame:
    return date_summary.agg(
        F.count(F.lit(1)).alias("days"), F.sum("dau").alias("total_dau"), money(F.sum("total_amount")).alias("gmv")
    )
