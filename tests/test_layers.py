"""Table builders on the micro shop: literal expected rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from micro import AS_OF, ORDERS, raw_tables, rows

from basketline.plans import dwd_reports, dws, dws_reports, ods_reports, quality
from basketline.plans.ads import ads_daily_kpis
from basketline.plans.layers import Layers
from basketline.schemas import SCHEMAS

JAN = lambda day: dt.date(2026, 1, day)


@pytest.fixture(scope="module")
def t(spark):
    return Layers(raw_tables(spark), AS_OF)


def test_dwd_orders(t):
    got = rows(t["dwd_orders"], "order_id", "username", "order_weekday", "is_valid_order", "is_first_order",
               "pay_latency_min")
    assert got == [
        ("O1", "ann", 4, 1, 1, 5), ("O2", "ann", 4, 0, 0, None), ("O3", "ann", 5, 1, 0, 0),
        ("O4", "ann", 6, 1, 0, 10), ("O5", "bob", 1, 0, 1, 1), ("O6", None, 7, 1, 1, 30),
    ]
    assert t["dwd_orders"].schema == SCHEMAS["dwd_orders"]


def test_orders_without_user_share_one_first_order(spark):
    orders = [("N1", None, D("1.00"), "paid", 0, dt.datetime(2026, 1, 2), None),
              ("N2", None, D("1.00"), "paid", 0, dt.datetime(2026, 1, 1), None)]
    t = Layers(raw_tables(spark, orders=orders), AS_OF)
    assert rows(t["dwd_orders"], "order_id", "is_first_order", "username") == [("N1", 0, None), ("N2", 1, None)]
    # Orders without a user are left out of the check.
    assert rows(quality.dq_first_orders(t["dwd_orders"]), "observed", "status") == [(0, "PASS")]


def test_facts_by_month(spark):
    t = Layers({name: (lambda df=df: df) for name, df in raw_tables(spark).items()}, AS_OF, by_month=True)
    plain = Layers(raw_tables(spark), AS_OF)
    for name in ("dwd_orders", "dwd_order_items"):
        assert rows(t[name].drop("order_month")) == rows(plain[name])
    assert all("order_month=" in f for f in t["dwd_orders"].inputFiles())
    assert "/ods_orders-" in t["ods_orders"].inputFiles()[0]


def test_dwd_items_drop_orphan_items_and_keep_unknown_products(spark):
    from micro import ITEMS

    t = Layers(raw_tables(spark, items=[*ITEMS, ("O99", "P1", 1, D("1.00"), D("1.00"))]), AS_OF)
    assert rows(t["dwd_order_items"], "order_id", "product_id", "category", "user_id", "is_valid_order") == [
        ("O1", "P1", "A", "U1", 1), ("O1", "P2", "B", "U1", 1), ("O2", "P2", "B", "U1", 0),
        ("O4", "P1", "A", "U1", 1), ("O6", "P9", None, "U9", 1),
    ]


MEASURES = ("user_id", "total_orders", "valid_orders", "total_quantity", "total_amount", "avg_order_amount",
            "avg_days_between", "is_repurchase")


def base(t, grain="order"):
    return dws.build_user_base(t["dwd_orders"], t["dwd_order_items"], t["ods_users"], AS_OF, grain)


def test_user_base_by_order(t):
    assert rows(base(t), *MEASURES) == [
        ("U1", 4, 3, 4, D("150.00"), D("50.00"), D("1.00"), 1),
        ("U2", 1, 0, 0, D("0.00"), None, D("0.00"), 0),
        ("U3", 0, 0, 0, D("0.00"), None, D("0.00"), 0),
    ]
    assert rows(base(t), "user_id", "first_order_date", "last_order_date", "days_since_last", "active_days") == [
        ("U1", JAN(1), JAN(3), 57, 3), ("U2", JAN(5), JAN(5), 55, 1), ("U3", None, None, None, 0),
    ]


def test_user_base_by_item_counts_an_order_once_per_item(t):
    got = rows(base(t, "item"), *MEASURES)
    assert got[0] == ("U1", 4, 4, 4, D("250.00"), D("62.50"), D("1.00"), 1)
    assert got[1:] == rows(base(t), *MEASURES)[1:]


def test_unknown_grain_is_refused(t):
    with pytest.raises(ValueError):
        base(t, "day")


def test_user_summary(t):
    summary = t["dws_user_summary"]
    assert summary.schema == SCHEMAS["dws_user_summary"]
    assert rows(summary, "user_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment",
                "favorite_category", "favorite_category_amount") == [
        ("U1", 1, 1, 1, "111", "H_Churned", "A", D("80.00")),
        ("U2", None, None, None, None, "H_Churned", None, None),
        ("U3", None, None, None, None, "H_Churned", None, None),
    ]
    assert rows(dws.dws_user_stats(summary)) == [(3, 1, 1)]


def test_favorite_tie_goes_to_the_first_category(spark):
    items = [("O1", "P2", 1, D("5.00"), D("5.00")), ("O1", "P1", 1, D("5.00"), D("5.00"))]
    t = Layers(raw_tables(spark, items=items), AS_OF)
    favorite = dws.add_favorite(t["ods_users"].select("user_id"), t["dwd_order_items"])
    assert rows(favorite)[0] == ("U1", "A", D("5.00"))


def test_product_summary(t):
    assert rows(t["dws_product_summary"], "product_id", "total_quantity", "total_orders", "total_users",
                "total_amount", "first_sale_date", "last_sale_date", "avg_quantity_per_order", "category_rank") == [
        ("P1", 3, 2, 1, D("80.00"), JAN(1), JAN(3), D("1.50"), 1),
        ("P2", 1, 1, 1, D("40.00"), JAN(1), JAN(1), D("1.00"), 1),
        ("P9", 1, 1, 1, D("10.00"), JAN(11), JAN(11), D("1.00"), 1),
    ]


def test_date_summary(t):
    assert rows(t["dws_date_summary"], "date", "dau", "new_users", "repurchase_users", "total_active_users",
                "total_orders", "valid_orders", "total_amount", "weekday") == [
        (JAN(1), 1, 1, 1, 1, 2, 1, D("100.00"), 4), (JAN(2), 1, 0, 1, 1, 1, 1, D("30.00"), 5),
        (JAN(3), 1, 0, 1, 1, 1, 1, D("20.00"), 6), (JAN(5), 0, 0, 0, 1, 1, 0, D("0.00"), 1),
        (JAN(11), 1, 1, 0, 1, 1, 1, D("10.00"), 7),
    ]
    averages = rows(t["dws_date_summary"], "date", "avg_order_value", "avg_user_amount")
    assert averages[3] == (JAN(5), None, None)


def test_user_behaviour_reports(t):
    kept = rows(dwd_reports.retention_d1_d7_d30(t), "first_date", "new_users", "d1_retained", "d7_retained",
                "d30_retained")
    assert kept == [(JAN(1), 1, 1, 1, 1), (JAN(11), 1, 0, 0, 0)]
    assert rows(dwd_reports.retention_d7(t)) == [(JAN(1), 1, D("100.00")), (JAN(11), 1, D("0.00"))]
    assert rows(dwd_reports.order_streaks(t, 3)) == [(3, 1)]
    assert rows(dwd_reports.funnel(t)) == [(3, 2, 1, 1)]
    assert rows(dwd_reports.repurchase_rate(t)) == [(2, 1, D("50.00"))]
    assert rows(dwd_reports.daily_new_users(t)) == [(JAN(1), 1), (JAN(11), 1)]
    assert rows(dwd_reports.prev_order(t), "order_id", "days_to_prev") == [
        ("O1", None), ("O3", 1), ("O4", 1), ("O6", None)]
    assert rows(dwd_reports.user_repurchase_cycle(t)) == [("U1", D("1.0000"), 2)]
    assert rows(dwd_reports.repurchase_interval_dist(t)) == [("0-7天", 2, D("100.00"))]
    assert rows(dwd_reports.active_30d(t, AS_OF)) == [(0,)]
    assert rows(dwd_reports.active_30d(t, JAN(20))) == [(1,)]
    assert rows(dwd_reports.rfm_levels(t, AS_OF), "user_id", "r", "f", "m_level") == [
        ("U1", 57, 3, "低"), ("U9", 49, 1, "低")]
    assert rows(dwd_reports.first_orders(t, 2), "order_id") == [("O1",), ("O5",)]
    assert rows(dwd_reports.cumulative_spend(t, "U1"), "order_id", "cumulative_spent") == [
        ("O1", D("100.00")), ("O3", D("130.00")), ("O4", D("150.00"))]


def test_funnel_with_and_without_unknown_states(spark):
    orders = [*ORDERS, ("O7", "U3", D("5.00"), "lost", 0, dt.datetime(2026, 1, 1), None)]
    t = Layers(raw_tables(spark, orders=orders), AS_OF)
    assert rows(dwd_reports.funnel(t)) == [(3, 2, 1, 1)]
    assert rows(dwd_reports.funnel(t, known_only=False)) == [(4, 2, 1, 1)]


def test_daily_kpis_have_one_row_per_day(t):
    kpis = rows(ads_daily_kpis(t), "date", "dau", "cohort_users", "d7_retention_pct")
    assert kpis[0] == (JAN(1), 1, 1, D("100.00")) and kpis[3] == (JAN(5), 0, None, None) and len(kpis) == 5


def test_previews_limit_in_order(t):
    assert [r.order_id for r in dwd_reports.order_seq(t, 2).collect()] == ["O1", "O3"]
    assert [r.order_id for r in dwd_reports.prev_order(t, 1).collect()] == ["O1"]


def test_every_builder_and_report_accepts_empty_tables(spark):
    t = Layers(raw_tables(spark, [], [], [], []), AS_OF)
    for name in ("dwd_orders", "dwd_order_items", "dws_user_summary", "dws_product_summary", "dws_date_summary"):
        assert t[name].count() == 0, name
    for report in (dwd_reports.order_seq, dwd_reports.prev_order, dwd_reports.cumulative_spend,
                   dwd_reports.retention_d7, dwd_reports.repurchase_interval_dist, dwd_reports.brand_rank,
                   dws_reports.vip_users, dws_reports.monthly_rollup, ods_reports.status_share, ads_daily_kpis):
        assert report(t).count() == 0, report.__name__
    assert rows(dwd_reports.funnel(t)) == [(0, 0, 0, 0)]
    assert rows(dwd_reports.repurchase_rate(t)) == [(0, 0, None)]


def test_day_with_only_anonymous_orders_has_no_retention_percentage(spark):
    orders = [*ORDERS, ("O7", None, D("5.00"), "paid", 0, dt.datetime(2025, 12, 1), None)]
    t = Layers(raw_tables(spark, orders=orders), AS_OF)
    got = rows(dwd_reports.retention_d7(t))
    assert got[0] == (dt.date(2025, 12, 1), 0, None) and len(got) == 3


def test_segment_dimension_names_every_segment(spark):
    dimension = dws_reports.segment_dimension(spark)
    assert dimension.count() == 8
    assert rows(dimension.where("rfm_segment like 'A%'"), "segment_label") == [("重要价值客户",)]
