"""Reports on the summary tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import SEGMENTS
from ..functions.money import money, ratio
from ..operators.ranking import top_k
from ..operators.summaries import share_of_total, table_census

Tables = Mapping[str, DataFrame]


def segment_dimension(spark: SparkSession) -> DataFrame:
    """Segment code, label and marketing strategy: eight rows."""
    names = ("rfm_segment", "segment_label", "marketing_strategy")
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in SEGMENTS))
    return spark.range(1).select(F.inline(rows))


def _buyers(t: Tables) -> DataFrame:
    return t["dws_user_summary"].where("valid_orders > 0")


def segment_distribution(t: Tables) -> DataFrame:
    return _buyers(t).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("user_count"),
        ratio(F.sum("total_amount"), F.count("total_amount")).alias("avg_amount"),
        ratio(F.sum("valid_orders"), F.count("valid_orders")).alias("avg_orders"),
    ).orderBy(F.desc("user_count"), "rfm_segment")


def vip_users(t: Tables, k: int = 20) -> DataFrame:
    """Highest spenders of the recent, frequent, high-spending segment."""
    users = t["dws_user_summary"].where(F.col("rfm_segment") == "A_Important_Value").select(
        "user_id", "username", "city", "user_level", "valid_orders", "total_amount", "days_since_last",
        "r_score", "f_score", "m_score", "rfm_score",
    )
    return top_k(users, [F.desc("total_amount"), F.asc("user_id")], k)


def win_back_users(t: Tables, k: int = 30) -> DataFrame:
    """Highest spenders among those to recover and those who left."""
    users = t["dws_user_summary"].where(F.col("rfm_segment").isin("D_Important_Recover", "H_Churned")).select(
        "user_id", "username", "city", "valid_orders", "total_amount",
        F.col("days_since_last").alias("days_inactive"), "r_score", "f_score", "m_score",
    )
    return top_k(users, [F.desc("total_amount"), F.asc("user_id")], k)


def segment_strategy(t: Tables) -> DataFrame:
    counts = _buyers(t).groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("user_count"))
    named = counts.join(F.broadcast(segment_dimension(counts.sparkSession)), "rfm_segment", "left")
    return named.select("rfm_segment", "user_count", "marketing_strategy").orderBy(
        F.desc("user_count"), "rfm_segment"
    )


def rfm_score_grid(t: Tables, k: int = 30) -> DataFrame:
    cells = _buyers(t).groupBy("r_score", "f_score", "m_score").agg(F.count(F.lit(1)).alias("user_count"))
    return top_k(cells, [F.desc("m_score"), F.desc("f_score"), F.desc("r_score")], k)


def segment_aov(t: Tables) -> DataFrame:
    """Mean of the users' mean order value, from the stored value and from amount / orders."""
    per_user = _buyers(t).select(
        "rfm_segment", "avg_order_amount",
        ratio(F.col("total_amount"), F.col("valid_orders"), 6).alias("calc"),
    )
    return per_user.groupBy("rfm_segment").agg(
        ratio(F.sum("avg_order_amount"), F.count("avg_order_amount")).alias("avg_aov"),
        ratio(F.sum("calc"), F.count("calc"), numerator_type="decimal(26,6)").alias("calc_aov"),
    ).orderBy(F.desc("avg_aov"), "rfm_segment")


def dws_table_census(t: Tables) -> DataFrame:
    return table_census({n: t[n] for n in ("dws_user_summary", "dws_product_summary", "dws_date_summary")})


def rfm_score_top20(t: Tables, k: int = 20) -> DataFrame:
    counts = _buyers(t).groupBy("rfm_score").agg(F.count(F.lit(1)).alias("user_count"))
    return top_k(counts, [F.desc("rfm_score")], k)


def repurchase_share(t: Tables) -> DataFrame:
    return share_of_total(_buyers(t), "is_repurchase", "user_count")


def top_spenders(t: Tables, k: int = 10) -> DataFrame:
    users = _buyers(t).select("user_id", "username", "city", "valid_orders", "total_amount", "rfm_segment")
    return top_k(users, [F.desc("total_amount"), F.asc("user_id")], k)


def top_products_dws(t: Tables, k: int = 10) -> DataFrame:
    products = t["dws_product_summary"].where("total_amount > 0").select(
        "product_id", "product_name", "category", "brand", "total_quantity", "total_amount", "total_users",
        "category_rank",
    )
    return top_k(products, [F.desc("total_amount"), F.asc("product_id")], k)


def monthly_rollup(t: Tables) -> DataFrame:
    return t["dws_date_summary"].groupBy("year", "month").agg(
        ratio(F.sum("dau"), F.count("dau"), 0).cast("bigint").alias("avg_dau"),
        F.sum("valid_orders").alias("total_orders"),
        money(F.sum("total_amount")).alias("monthly_gmv"),
    ).orderBy("year", "month")
