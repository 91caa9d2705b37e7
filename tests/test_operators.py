"""Operators against Spark's own windows, on skewed random rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from micro import rows
from pyspark.sql import Window as W, functions as F

from basketline.operators import cohorts, ranking, summaries, windows


@pytest.fixture(scope="module")
def facts(spark):
    """2,000 rows, half of them of one key, some without key, time or value; many ties in time."""
    n = F.col("id")
    key = F.when(n % 2 == 0, "hot").when(n % 41 == 0, None).otherwise(F.concat(F.lit("k"), (n % 37).cast("string")))
    time = F.timestamp_seconds(F.lit(1_700_000_000) + (n * 7919 % 997) * 3600).cast("timestamp_ntz")
    return spark.range(2000).select(
        key.alias("user"), F.when(n % 53 != 0, time).alias("t"), n.alias("id"),
        F.when(n % 11 != 0, (n * 31 % 500).cast("decimal(12,2)")).alias("v"),
    ).cache()


def test_sequence_number(facts):
    got = windows.sequence_number(facts, ["user"], ["t", "id"], "seq")
    expected = facts.withColumn("seq", F.row_number().over(W.partitionBy("user").orderBy("t", "id")))
    assert rows(got, "id", "user", "seq") == rows(expected, "id", "user", "seq")


def test_running_sum_shares_totals_among_ties(facts):
    got = windows.running_sum(facts, ["user"], "t", "v", "total")
    expected = facts.withColumn("total", F.sum("v").over(W.partitionBy("user").orderBy("t")))
    assert rows(got, "id", "total") == rows(expected, "id", "total")


def test_with_previous(facts):
    got = windows.with_previous(facts, ["user"], ["t", "id"], {"t": "pt", "v": "pv"})
    order = W.partitionBy("user").orderBy("t", "id")
    expected = facts.withColumn("pt", F.lag("t").over(order)).withColumn("pv", F.lag("v").over(order))
    assert rows(got, "id", "user", "pt", "pv") == rows(expected, "id", "user", "pt", "pv")


def test_hot_key_with_one_single_time(spark):
    """All rows of the hot key fall on one moment: slices go by the unique column too."""
    n = F.col("id")
    df = spark.range(4000).select(
        F.when(n % 4 == 0, F.concat(F.lit("k"), (n % 50).cast("string"))).otherwise("hot").alias("user"),
        F.when(n % 7 != 0, F.lit("2026-01-01 10:00:00").cast("timestamp_ntz")).alias("t"), n.alias("id"),
        (n % 10).alias("v"))
    order = W.partitionBy("user").orderBy("t", "id")
    expected = df.select("*", F.row_number().over(order).alias("seq"), F.lag("v").over(order).alias("pv"),
                         F.sum("v").over(W.partitionBy("user").orderBy("t")).alias("total"))
    seq = windows.sequence_number(df, ["user"], ["t", "id"], "seq")
    previous = windows.with_previous(df, ["user"], ["t", "id"], {"v": "pv"})
    total = windows.running_sum(df, ["user"], "t", "v", "total")
    assert rows(seq, "id", "seq") == rows(expected, "id", "seq")
    assert rows(previous, "id", "pv") == rows(expected, "id", "pv")
    assert rows(total, "id", "total") == rows(expected, "id", "total")


def test_hot_key_fills_several_even_slices(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("user"), F.lit(1).alias("t"), "id")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        placed = windows._sliced(df, ["user"], ["t", "id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in placed.groupBy("__slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_running_sum_example(spark):
    at = lambda h: dt.datetime(2026, 1, 1, h)
    df = spark.createDataFrame([("u", at(10), 100), ("u", at(10), 50), ("u", at(12), 30), ("u", at(13), 20)],
                               "user string, t timestamp_ntz, v int")
    assert rows(windows.running_sum(df, ["user"], "t", "v", "s"), "v", "s") == [
        (20, 200), (30, 180), (50, 150), (100, 150)]


@pytest.mark.parametrize("dense", [False, True])
def test_rank_within(facts, dense):
    known = facts.withColumn("v", F.col("v") - 250)  # negative values too
    rank = F.dense_rank() if dense else F.rank()
    expected = known.withColumn("r", rank.over(W.partitionBy("user").orderBy(F.desc_nulls_last("v"))))
    got = ranking.rank_within(known, ["user"], "v", "r", dense)
    assert rows(got, "id", "v", "r") == rows(expected, "id", "v", "r")


def test_rank_ascending(facts):
    expected = facts.withColumn("r", F.rank().over(W.partitionBy("user").orderBy(F.asc_nulls_last("v"))))
    got = ranking.rank_within(facts, ["user"], "v", "r", descending=False)
    assert rows(got, "id", "r") == rows(expected, "id", "r")


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 7, 1000, 1003])
def test_ntile_scores(spark, count):
    df = spark.range(count).select(F.format_string("U%05d", "id").alias("u"), (F.col("id") * 7 % 13).alias("a"),
                                   (F.col("id") * 17 % 1009).alias("b"))
    got = ranking.ntile_scores(df, {"x": F.col("a"), "y": -F.col("b")}, "u", 5)
    expected = df.withColumn("x", F.ntile(5).over(W.orderBy("a", "u"))).withColumn(
        "y", F.ntile(5).over(W.orderBy(F.desc("b"), "u")))
    assert rows(got, "u", "x", "y") == rows(expected, "u", "x", "y")


def test_ntile_where_leaves_other_rows_without_score(spark):
    df = spark.range(20).select(F.format_string("U%02d", "id").alias("u"), F.col("id").alias("a"))
    got = ranking.ntile_scores(df, {"x": F.col("a")}, "u", 5, where=F.col("a") >= 10)
    assert rows(got.where("a < 10").select("x").distinct()) == [(None,)]
    assert rows(got.where("a >= 10").groupBy("x").count()) == [(i, 2) for i in range(1, 6)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_exact_quantiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = ranking.exact_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def days(spark, data):
    rows_ = [(u, dt.date(2026, 1, 1) + dt.timedelta(d)) for u, d in data]
    return spark.createDataFrame(rows_, "u string, d date")


user_days = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(user_days)
def test_streaks_and_retention_and_intervals(spark, data):
    df = days(spark, data)
    per_user = {}
    for u, d in data:
        per_user.setdefault(u, []).append(d)

    runs = {}
    for ds in per_user.values():
        unique = sorted(set(ds))
        length = 1
        for before, now in zip(unique, unique[1:]):
            if now == before + 1:
                length += 1
            else:
                runs[length] = runs.get(length, 0) + 1
                length = 1
        runs[length] = runs.get(length, 0) + 1
    assert rows(cohorts.streaks(df, "u", "d", 1)) == sorted(runs.items())

    cohort = {}
    for ds in per_user.values():
        first = min(ds)
        entry = cohort.setdefault(first, [0, 0])
        entry[0] += 1
        entry[1] += any(1 <= d - first <= 7 for d in ds)
    start = dt.date(2026, 1, 1)
    expected = sorted((start + dt.timedelta(f), n, k) for f, (n, k) in cohort.items())
    assert rows(cohorts.retention(df, "u", "d"), "first_date", "new_users", "d7_retained") == expected

    gaps = {}
    for ds in per_user.values():
        ordered = sorted(ds)
        for before, now in zip(ordered, ordered[1:]):
            label = "short" if now - before <= 3 else "long"
            gaps[label] = gaps.get(label, 0) + 1
    got = cohorts.interval_histogram(df, "u", "d", [(3, "short")], "long", share=False)
    assert rows(got) == sorted(gaps.items())


def test_funnel_counts_users_once(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), (None, "y")], "u string, e string")
    steps = {"all": F.lit(True), "x": F.col("e") == "x", "y": F.col("e") == "y"}
    assert rows(cohorts.funnel(df, "u", steps)) == [(2, 2, 1)]


def test_top_n_first_rows_and_shares(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 9), (None, 8)], "k string, v int")
    assert rows(windows.top_n_per_group(df, ["k"], [F.desc("v")])) == [(None, 9), ("a", 3), ("b", 2)]
    assert rows(windows.first_rows(df, ["k"], ["v"], ["v"])) == [(None, 8), ("a", 1), ("b", 2)]
    assert rows(summaries.share_of_total(df, "k")) == [(None, 2, D("40.00")), ("a", 2, D("40.00")), ("b", 1, D("20.00"))]
    assert rows(summaries.value_counts(df, "k")) == [("a", 2), ("b", 1)]
    census = summaries.table_census({"x": df, "y": df}, {"m": {"x": F.sum("v")}})
    assert rows(census) == [("x", 5, 23), ("y", 5, None)]
    assert rows(summaries.having_duplicates(df, ["k"])) == [(None, 2), ("a", 2)]


def test_top_k_and_report(spark, capsys):
    df = spark.range(100).select("id", (F.col("id") % 10).alias("v"))
    assert [r.id for r in ranking.top_k(df, [F.desc("v"), F.asc("id")], 2).collect()] == [9, 19]
    summaries.report(df.limit(1), "a title")
    assert "a title" in capsys.readouterr().out


def test_ntile_equals_the_builtin_one_on_fractions_and_nulls(spark):
    for n in (0, 1, 4, 7, 10, 23):
        data = [(f"u{i:02d}", None if i % 5 == 4 else (i * 7 % 10) / 1000) for i in range(n)]
        df = spark.createDataFrame(data, "id string, v double")
        got = ranking.ntile_scores(df, {"a": F.col("v"), "d": -F.col("v")}, "id", 5, nulls_last=["d"])
        expected = df.select("id", F.ntile(5).over(W.orderBy("v", "id")).alias("a"),
                             F.ntile(5).over(W.orderBy(F.desc("v"), "id")).alias("d"))
        assert rows(got, "id", "a", "d") == rows(expected, "id", "a", "d")


def test_missing_days_are_a_cohort_but_no_interval(spark):
    import datetime as dt

    day = dt.date(2026, 1, 1)
    df = spark.createDataFrame([("a", day), ("a", day + dt.timedelta(9)), ("a", None), ("a", None), ("a", None), ("b", None)],
                               "u string, d date")
    assert rows(cohorts.retention(df, "u", "d"), "first_date", "new_users") == [(None, 1), (day, 1)]
    found = cohorts.interval_histogram(df, "u", "d", [(7, "0-7")], "rest")
    assert rows(found, "interval_range", "repurchase_count") == [("rest", 1)]
