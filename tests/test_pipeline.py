"""The whole run, its gate, checks, cleaning, incremental loads."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from pathlib import Path

import pytest
from micro import ORDERS, raw_tables, rows

from basketline.plans import cleaning, dwd_reports, pipeline, profiling, quality
from basketline.schemas import SCHEMAS
from basketline.sources import generate
from basketline.sources.tables import read_table
from basketline.storage import shared_folder
from basketline.streaming.incremental import incremental_load, last_load_time, read_loaded

AS_OF = "2026-03-01"
BANDS = {"dws_user_summary": (200, 200), "dws_product_summary": (1, 50), "dws_date_summary": (300, 367)}


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    generate.generate_sources(spark, folder, 200, 50, 3000, as_of=AS_OF)
    return folder


@pytest.fixture(scope="module")
def warehouse(spark, source, tmp_path_factory):
    folder = tmp_path_factory.mktemp("wh")
    return folder, pipeline.run_pipeline(spark, source, str(folder), AS_OF, BANDS)


def test_pipeline_reruns_to_the_same_tables(spark, source, warehouse):
    folder, t = warehouse
    first = {n: rows(df) for n, df in t.items()}
    again = pipeline.run_pipeline(spark, source, str(folder), AS_OF, BANDS)
    assert {n: rows(df) for n, df in again.items()} == first
    assert len(first) == 10
    assert (folder / "dwd_orders" / "order_month=2025-12").is_dir()
    assert not (folder / "_running").exists()
    # Header totals equal item sums in generated data, and so do the summaries built from each.
    assert rows(quality.dq_header_vs_items(again["ods_orders"], again["ods_order_items"]), "status") == [("PASS",)]
    users, products, days = (again[f"dws_{n}_summary"] for n in ("user", "product", "date"))
    totals = [df.agg({"total_amount": "sum"}).first()[0] for df in (users, products, days)]
    assert totals[0] == totals[1] == totals[2]


def test_pipeline_removes_its_intermediate_tables(spark, tmp_path):
    files = lambda: set(Path(shared_folder(spark)).rglob("*.parquet"))
    before = files()
    generate.generate_sources(spark, str(tmp_path / "raw"), 5, 5, 8, as_of=AS_OF)
    t = pipeline.run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "wh"), AS_OF, None)
    assert t["dws_user_summary"].count() == 5
    assert files() == before


def test_period_reports_skip_other_months(spark, warehouse):
    t = {"dwd_orders": read_table(spark, str(warehouse[0]), "dwd_orders")}
    report = dwd_reports.active_30d(t, AS_OF)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    plain = dwd_reports.active_30d({"dwd_orders": t["dwd_orders"].drop("order_month")}, AS_OF)
    assert rows(report) == rows(plain)


def test_gate_stops_the_run(spark, tmp_path):
    generate.generate_sources(spark, str(tmp_path / "raw"), 5, 5, 8, as_of=AS_OF)
    with pytest.raises(quality.QualityError, match="dws_user_summary: 5"):
        pipeline.run_pipeline(
            spark, str(tmp_path / "raw"), str(tmp_path / "wh"), AS_OF, {"dws_user_summary": (6, 10)})
    assert not (tmp_path / "wh" / "ads_daily_kpis").exists()
    assert not (tmp_path / "wh" / "_running").exists()


def test_two_runs_exclude_each_other(spark, source, tmp_path):
    (tmp_path / "wh").mkdir()
    (tmp_path / "wh" / "_running").touch()
    with pytest.raises(pipeline.AlreadyRunning):
        pipeline.run_pipeline(spark, source, str(tmp_path / "wh"), AS_OF, BANDS)


@pytest.mark.parametrize("count,status", [(9, "FAIL"), (10, "PASS"), (20, "PASS"), (21, "FAIL")])
def test_row_bands_include_their_ends(spark, count, status):
    checks = quality.dq_row_bands({"t": spark.range(count)}, {"t": (10, 20)})
    assert rows(checks) == [("row_count", "t", count, 10, 20, status)]
    if status == "FAIL":
        with pytest.raises(quality.QualityError):
            quality.require(checks)
    else:
        quality.require(checks)


def order(order_id, user="U1", amount="1.00", status="paid", time="2026-01-01 00:00:00"):
    amount = None if amount is None else D(amount)
    return (order_id, user, amount, status, 1, dt.datetime.fromisoformat(time), None)


BAD = [order("A", user=None), order("B", amount=None), order("C", amount="0.00"), order("D", amount="-5.00"),
       order("E", amount="100000.00"), order("F", amount="100000.01"), order("G", status="Paid"),
       order("H", status=None)]


def test_order_checks(spark):
    t = raw_tables(spark, orders=BAD)
    assert rows(quality.dq_orders(t["ods_orders"]), "check", "observed", "status") == [
        ("invalid_amount", 2, "FAIL"), ("null_amount", 1, "FAIL"), ("null_user", 1, "FAIL"),
        ("suspicious_amount", 1, "FAIL"), ("total", 8, "PASS")]
    assert rows(quality.dq_status_domain(t["ods_orders"]), "observed") == [(2,)]
    empty = raw_tables(spark, orders=[])["ods_orders"]
    assert {r.status for r in quality.dq_orders(empty).collect()} == {"PASS"}


def test_key_orphan_and_width_checks(spark):
    items = [("O1", "P1", 1, D("1"), D("1")), ("O1", "P1", 1, D("1"), D("1")), ("O8", "P9", 1, D("1"), D("1"))]
    t = raw_tables(spark, items=items)
    assert rows(quality.dq_primary_key(t["ods_order_items"], "i", ["order_id", "product_id"]), "check", "observed") == [
        ("duplicate_keys", 1), ("null_keys", 0)]
    found = quality.dq_orphans(t["ods_orders"], t["ods_order_items"], t["ods_users"], t["ods_products"])
    assert rows(found, "check", "observed") == [
        ("unknown_order_id", 1), ("unknown_product_id", 1), ("unknown_user_id", 1)]
    wide = raw_tables(spark, users=[("U" * 21, "n", "M", 1, "c", "p", "Gold", None)])["ods_users"]
    assert rows(quality.dq_text_widths(wide, "ods_users").where("status = 'FAIL'"), "check", "observed") == [
        ("longest_user_id", 21)]


def test_clean_orders_keep_the_latest_plausible_row(spark):
    orders = [*BAD[:6], order("X", amount="1.00"), order("X", amount="2.00", time="2026-01-02 00:00:00"),
              order("X", amount="3.00", time="2026-01-02 00:00:00"), (None, "U1", D("1"), "paid", 1, None, None)]
    t = raw_tables(spark, orders=orders)["ods_orders"]
    kept = cleaning.clean_orders(t)
    assert rows(kept, "order_id", "total_amount") == [("E", D("100000.00")), ("X", D("3.00"))]
    assert kept.columns == t.columns
    assert rows(cleaning.quarantined_orders(t), "order_id", "reason") == [
        (None, "null_order_id"), ("A", "null_user"), ("B", "null_amount"), ("C", "invalid_amount"), ("D", "invalid_amount"),
        ("F", "suspicious_amount")]


def test_incremental_loads(spark, tmp_path):
    orders = raw_tables(spark)["ods_orders"]
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    load = lambda upto=None: incremental_load(spark, orders, target, state, "orders", "create_time", upto)
    assert load("2026-01-02 23:59:59") == 3
    assert last_load_time(spark, state, "orders") == "2026-01-02 23:59:59"
    assert load() == 3
    assert load() == 0
    assert load() == 0
    loaded = read_loaded(spark, target)
    assert rows(loaded, "order_id") == [(o[0],) for o in ORDERS]
    assert loaded.select("load_after").distinct().count() == 2


def test_incremental_load_that_failed_before_its_mark_is_repeated_without_copies(spark, tmp_path, monkeypatch):
    from basketline.streaming import incremental

    orders = raw_tables(spark)["ods_orders"]
    target, state = str(tmp_path / "t"), str(tmp_path / "s")

    class Stop(Exception):
        pass

    def fail(*_):
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(incremental.F, "count", fail)
        with pytest.raises(Stop):
            incremental_load(spark, orders, target, state, "orders", "create_time")
    assert incremental_load(spark, orders, target, state, "orders", "create_time") == 6
    assert read_loaded(spark, target).count() == 6


def test_profiles(spark):
    t = raw_tables(spark)
    assert rows(profiling.profile_orders(t["ods_orders"]), "orders", "avg_amount", "max_amount") == [
        (6, D("46.67"), D("100.00"))]
    assert rows(profiling.value_counts_status(t["ods_orders"]))[2] == ("received", 1)
    assert rows(profiling.value_counts_category(t["ods_products"])) == [("A", 1), ("B", 1)]
    assert [tuple(r) for r in profiling.city_top5(t["ods_users"]).collect()] == [("X", 2), ("Y", 1)]
    assert rows(profiling.describe_price(t["ods_products"])) == [
        (2, D("35.0000"), D("7.0711"), D("30.0000"), D("32.5000"), D("35.0000"), D("37.5000"), D("40.0000"))]
    assert profiling.preview(t["ods_users"], 2).count() == 2
    assert ("age", "int") in rows(profiling.column_types(t["ods_users"]))


def test_incremental_load_by_key_takes_late_rows_and_rows_without_a_time(spark, tmp_path):
    import datetime as dt

    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    t = lambda day: dt.datetime(2026, 1, day)
    frame = lambda data: spark.createDataFrame(data, "id int, time timestamp_ntz")
    load = lambda data: incremental_load(spark, frame(data), target, state, "x", "time", key=["id"])
    assert load([(1, t(2)), (2, None)]) == 2
    assert load([(1, t(2)), (2, None), (3, t(1)), (4, None)]) == 2
    assert load([(1, t(2)), (3, t(1))]) == 0
    assert rows(read_loaded(spark, target), "id") == [(1,), (2,), (3,), (4,)]
