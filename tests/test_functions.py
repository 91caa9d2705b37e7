"""Expressions: dates across midnight and zones, rounding, rules, draws."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from micro import rows
from pyspark.sql import functions as F

from basketline.functions import dates, draws, money, rules


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_weekday_and_month(spark):
    day = lambda text: F.lit(text).cast("date")
    assert one(spark, dates.iso_weekday(day("2026-01-05")), dates.iso_weekday(day("2026-01-11"))) == (1, 7)
    assert one(spark, dates.month_key(day("2026-01-05"))) == ("2026-01",)


def test_whole_minutes_truncate_toward_zero(spark):
    pairs = [("2026-01-01 10:00:00", "2026-01-01 10:05:59", 5), ("2026-01-01 23:59:59", "2026-01-02 00:00:00", 0),
             ("2026-01-01 00:00:00", "2026-01-03 01:02:00", 2942), ("2026-01-01 00:01:30", "2026-01-01 00:00:00", -1)]
    for a, b, minutes in pairs:
        assert one(spark, dates.whole_minutes(ntz(a), ntz(b))) == (minutes,)


def test_whole_minutes_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # clocks jump from 02:00 to 03:00
        assert one(spark, dates.whole_minutes(ntz("2026-03-29 01:30:00"), ntz("2026-03-29 03:30:00"))) == (120,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratio_rounds_once_half_up_and_guards_zero(spark):
    value = lambda n, d, **k: one(spark, money.ratio(F.lit(D(n)), F.lit(d), **k))[0]
    assert value("2.01", 2) == D("1.01")
    assert value("1.00", 3) == D("0.33")
    assert value("0.0449999", 1, numerator_type="decimal(20,7)") == D("0.04")
    assert value("5.00", 0) is None
    assert one(spark, money.percent(F.lit(1), F.lit(8))) == (D("12.50"),)


def test_bins(spark):
    bins = [(7, "week"), (30, "month")]
    got = [one(spark, rules.bucketize(F.lit(v), bins, "later"))[0] for v in (0, 7, 8, 30, 31)]
    assert got == ["week", "week", "month", "month", "later"]
    got = [one(spark, rules.bucketize_at_least(F.lit(v), [(5, "a"), (2, "b")], "c"))[0] for v in (5, 4, 2, 1)]
    assert got == ["a", "b", "b", "c"]


@pytest.mark.parametrize("scores,segment", [
    ((5, 5, 5), "A"), ((1, 4, 4), "B"), ((4, 2, 5), "C"), ((2, 1, 4), "D"), ((5, 4, 2), "E"), ((2, 5, 1), "F"),
    ((4, 1, 1), "G"), ((1, 1, 1), "H"), ((3, 5, 5), "H"), ((5, 5, 3), "H"), ((None, None, None), "H"),
])
def test_segments(spark, scores, segment):
    columns = [F.lit(s).cast("int") for s in scores]
    assert one(spark, rules.rfm_segment(*columns))[0][0] == segment


def test_score_text_is_null_without_scores(spark):
    a, none = F.lit(4), F.lit(None).cast("int")
    assert one(spark, rules.rfm_score(a, a, F.lit(1)), rules.rfm_score(a, none, a)) == ("441", None)


def test_clamp_padding_and_validity(spark):
    assert one(spark, rules.clamp(F.lit(9), 1, 5), rules.clamp(F.lit(0), 1, 5)) == (5, 1)
    assert one(spark, rules.padded_id("U", F.lit(42), 8)) == ("U00000042",)
    assert one(spark, rules.padded_id("P", F.lit(1234567), 6)) == ("P1234567",)
    status = lambda s: rules.valid_order(F.lit(s).cast("string"))
    assert one(spark, status("paid"), status("PAID"), status("refunded"), status(None)) == (1, 0, 0, 0)


def test_weighted_choice_follows_its_weights(spark):
    pick = draws.weighted_choice(draws.uniform(7, "w", F.col("id")), ["a", "b", "c"], [5, 3, 2])
    counts = dict(rows(spark.range(50_000).groupBy(pick).count()))
    assert [round(counts[k] / 50_000, 2) for k in "abc"] == pytest.approx([0.5, 0.3, 0.2], abs=0.015)


def test_draws_are_the_same_for_any_partitioning(spark):
    u = draws.uniform(1, "x", F.col("id"))
    assert rows(spark.range(0, 100, 1, 1).select("id", u)) == rows(spark.range(0, 100, 1, 7).select("id", u))


def test_normal_has_mean_zero_and_deviation_one(spark):
    x = draws.normal(3, "n", F.col("id"))
    mean, sd = spark.range(50_000).select(F.mean(x), F.stddev(x)).first()
    assert mean == pytest.approx(0, abs=0.02) and sd == pytest.approx(1, abs=0.02)


def test_distinct_picks_are_distinct_and_uniform(spark):
    pick = lambda n, count, domain, most: draws.with_distinct_picks(
        spark.range(n), "p", 5, "p", F.col("id"), F.lit(count), domain, most)
    df = pick(20_000, 3, 4, 3)
    assert df.where("size(array_distinct(p)) <> 3 or array_min(p) < 1 or array_max(p) > 4").count() == 0
    counts = dict(rows(df.select(F.explode("p").alias("x")).groupBy("x").count()))
    assert all(c / 20_000 == pytest.approx(0.75, abs=0.02) for c in counts.values()) and len(counts) == 4
    assert rows(pick(50, 5, 5, 5).select(F.array_sort("p")).distinct())[0][0] == [1, 2, 3, 4, 5]
    assert rows(pick(50, 2, 9, 5).select(F.size("p")).distinct()) == [(2,)]
    with pytest.raises(ValueError):
        pick(1, 1, 4, 5)


def test_average_gap(spark):
    day = lambda d: F.lit(dt.date(2026, 1, d))
    assert one(spark, dates.average_gap(day(1), day(11), F.lit(4))) == (D("3.33"),)
    assert one(spark, dates.average_gap(day(1), day(1), F.lit(1))) == (D("0.00"),)
