"""Rejected records, arrivals, partial summaries, distinct sets, keyed updates, restarts."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from micro import rows
from pyspark.sql import Observation, functions as F

from basketline.operators.distinct_sets import dense_numbers, distinct_over, member_sets, with_numbers
from basketline.plans import dwd, dws, partials, pipeline, quality
from basketline.schemas import SCHEMAS
from basketline.sources import checked, files, generate, tables
from basketline.storage import new_path
from basketline.streaming.arrivals import load_arrivals, read_arrivals

HEADER = "order_id,user_id,total_amount,status,item_count,create_time,pay_time\n"
AS_OF = "2026-03-01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    generate.generate_sources(spark, folder, 40, 15, 400, as_of=AS_OF)
    return folder


@pytest.fixture(scope="module")
def ods(spark, raw):
    return tables.load_ods(spark, raw)


# Rejected records

def test_records_that_do_not_fit_are_set_aside_with_the_reason(spark, tmp_path):
    lines = [
        ("O1,U1,10.50,paid,1,2026-01-01 10:00:00,", None), ("O2,U1,abc,paid,1,2026-01-01 10:00:00,", "total_amount is not decimal(12,2)"),
        ("O3,U1,1.5,paid,two,not a time,", "item_count is not int"), ("O4,U1", "too few fields"),
        ("O5,U1,1,paid,1,2026-01-01,2026-01-01,extra", "too many fields"), (",,,,,,", None), ("O7,U1,1.555,paid,,not a time,", None),
        ("O6,U1,12345678901.55,paid,1,2026-01-01,", "total_amount is not decimal(12,2)"), ("O9,U1,1,paid,3000000000,,", "item_count is not int"),
        ('O8,"a, ""b""",2,paid,x1,,', "item_count is not int"), ("O10,U1,abc,paid,two,,", "total_amount is not decimal(12,2)"),
    ]
    (tmp_path / "orders.csv").write_text(HEADER + "\n".join(line for line, _ in lines) + "\n")
    found = checked.read_csv_checked(spark, str(tmp_path / "orders.csv"), SCHEMAS["ods_orders"])
    assert found.loaded.schema == SCHEMAS["ods_orders"]
    assert rows(found.rejected) == sorted((line, reason) for line, reason in lines if reason)
    assert rows(found.loaded, "order_id", "total_amount") == sorted(
        [("O1", D("10.50")), (None, None), ("O7", D("1.56"))], key=lambda r: str(r[0] or ""))
    assert found.loaded.count() + found.rejected.count() == len(lines)
    checks = {r.check: (r.observed, r.status) for r in quality.dq_rejected_rows(found.loaded, found.rejected, "ods_orders").collect()}
    assert checks["records"] == (11, "PASS") and checks["loaded"] == (3, "PASS") and checks["rejected: too few fields"] == (1, "FAIL")


def test_checked_reading_of_quoted_breaks(spark, tmp_path):
    (tmp_path / "o.csv").write_text(HEADER + 'O1,"U\n1",1,paid,1,,\nO2,"U\n2",abc,paid,1,,\n')
    found = checked.read_csv_checked(spark, str(tmp_path / "o.csv"), SCHEMAS["ods_orders"])
    assert rows(found.loaded, "user_id") == [("U\n1",)]
    assert rows(found.rejected) == [('O2,"U\n2",abc,paid,1,,', "total_amount is not decimal(12,2)")]


def test_malformed_records_stop_the_run_unless_accepted(spark, raw, tmp_path):
    folder = tmp_path / "raw"
    for name in tables.ODS_FILES.values():
        tables_csv = spark.read.text(f"{raw}/{name}")
        lines = [r.value for r in tables_csv.collect()]
        header = next(x for x in lines if x.startswith(("user_id,u", "product_id,product_n", "order_id,")))
        body = [x for x in lines if x != header]
        extra = ["O_bad,U1,much,paid,1,2026-01-01 00:00:00,"] if name == "orders.csv" else []
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join([header, *body, *extra]) + "\n")
    with pytest.raises(checked.MalformedRecords, match="1 total_amount is not decimal"):
        pipeline.run_pipeline(spark, str(folder), str(tmp_path / "wh"), AS_OF)
    assert not (tmp_path / "wh" / "ods_orders").exists()
    t = pipeline.run_pipeline(spark, str(folder), str(tmp_path / "wh"), AS_OF, max_rejected=1)
    assert t["ods_orders"].count() == 400
    assert rows(spark.read.parquet(str(tmp_path / "wh" / "ods_orders_rejected")), "reason") == [("total_amount is not decimal(12,2)",)]


def test_large_files_without_quoted_breaks_are_split(spark, tmp_path):
    path = str(tmp_path / "users.csv")
    line = "U{0},\"name, {0}\",M,1,c,1,Gold,2026-01-01\n"
    Path(path).write_text("user_id,username,gender,age,city,phone,level,register_date\n" + "".join(line.format(i) for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(path) // 4))
    try:
        split, whole = (files.read_csv(spark, path, SCHEMAS["ods_users"], multiline=m) for m in (None, True))
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert rows(split) == rows(whole)
        stored = tables.load_ods_table(spark, str(tmp_path), "ods_users", str(tmp_path / "wh"))
        assert stored.count() == 20000
        Path(path).write_text(Path(path).read_text() + 'Ux,"a\nb",M,1,c,1,Gold,2026-01-01\n')
        assert files.has_quoted_breaks(spark, path)
        assert files.read_csv(spark, path, SCHEMAS["ods_users"]).where("username = 'a\\nb'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# Arrivals

def test_arrivals_load_once_whatever_their_times(spark, ods, tmp_path):
    orders = ods["ods_orders"].withColumn("create_time", F.when(F.col("order_id") < "O000000050", None).otherwise(F.col("create_time")))
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    load = lambda n: load_arrivals(spark, landing, target, state, orders.schema, n, max_files=1)
    loaded = lambda: read_arrivals(spark, target, orders.schema)
    assert loaded().count() == 0
    cut = F.crc32("order_id") % 3
    for n in range(3):
        orders.where(cut == n).repartition(2).write.mode("append").parquet(landing)
        load(n)
        load(n + 100)  # nothing new
        assert loaded().count() == orders.where(cut <= n).count()
    assert {r[0] for r in loaded().select("load_number").distinct().collect()} == {0, 1, 2}
    assert rows(loaded().drop("load_number")) == rows(orders)


def test_a_load_that_was_killed_is_repeated_without_doubling(spark, ods, tmp_path):
    orders = ods["ods_orders"]
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    load = lambda n: load_arrivals(spark, landing, target, state, orders.schema, n)
    orders.where("order_id <= 'O000000200'").coalesce(1).write.mode("append").parquet(landing)
    load(1)
    last = lambda folder: [p for p in Path(folder).iterdir() if p.name.strip(".").split(".")[0] == "0"]
    for p in last(f"{state}/commits"):  # written, but not noted in the checkpoint
        p.unlink()
    load(1)
    assert rows(read_arrivals(spark, target, orders.schema).drop("load_number")) == rows(orders.where("order_id <= 'O000000200'"))
    orders.where("order_id > 'O000000200'").coalesce(1).write.mode("append").parquet(landing)
    orders.withColumn("load_number", F.lit(2)).coalesce(1).write.mode("append").parquet(str(tmp_path / "stray"))
    stray = next((tmp_path / "stray").glob("*.parquet"))  # what a run killed while writing leaves behind
    (tmp_path / "target" / stray.name).write_bytes(stray.read_bytes())
    load(2)
    assert rows(read_arrivals(spark, target, orders.schema).drop("load_number")) == rows(orders)


# Summaries by loads

def _full(ods):
    orders = dwd.build_dwd_orders(ods["ods_orders"], ods["ods_users"])
    items = dwd.build_dwd_order_items(ods["ods_order_items"], ods["ods_orders"], ods["ods_products"])
    users = dws.build_user_summary(orders, items, ods["ods_users"], AS_OF)
    return [rows(users), rows(dws.build_product_summary(items)), rows(dws.build_date_summary(orders, users))]


def test_summaries_after_any_loads_equal_the_full_build(spark, ods, tmp_path):
    orders = ods["ods_orders"].withColumns({
        "user_id": F.when(F.crc32("order_id") % 17 == 0, None).otherwise(F.col("user_id")),
        "total_amount": F.when(F.crc32("order_id") % 13 == 0, None).otherwise(F.col("total_amount")),
        "create_time": F.when(F.crc32("order_id") % 19 == 0, None).otherwise(F.col("create_time")),
    })
    part = lambda *k: orders.where((F.crc32("order_id") % 4).isin(*k))
    items = lambda o: ods["ods_order_items"].join(o.select("order_id"), "order_id", "left_semi")
    store = partials.PartialStore(spark, str(tmp_path / "store"))
    add = lambda name, o: store.add(name, o, items(o), ods["ods_products"])

    def check(o):
        t = store.tables()
        found = [partials.user_summary(t, ods["ods_users"], AS_OF), partials.product_summary(t), partials.date_summary(t)]
        assert [rows(df) for df in found] == _full({**ods, "ods_orders": o, "ods_order_items": items(o)})

    with pytest.raises(ValueError):
        store.tables()
    for k in range(3):
        add(f"load-{k}", part(k))
    check(part(0, 1, 2))
    store.remove("load-1")
    add("load-2", part(2, 3))  # replaced
    add("load-2", part(2, 3))
    assert store.loads() == ["load-0", "load-2"]
    check(part(0, 2, 3))
    store.compact(["load-0", "load-2"], "base")
    add("load-1", part(1))
    assert store.loads() == ["base", "load-1"]
    check(orders)
    folders = [p for p in (tmp_path / "store" / "buyers").iterdir() if p.is_dir()]
    assert len(folders) == 2  # replaced and merged partials are gone


def test_a_load_that_was_cut_off_does_not_count(spark, ods, tmp_path, monkeypatch):
    store = partials.PartialStore(spark, str(tmp_path))
    add = lambda: store.add("a", ods["ods_orders"], ods["ods_order_items"], ods["ods_products"])
    monkeypatch.setattr(partials, "write_text", lambda *a: (_ for _ in ()).throw(OSError("cut")))
    with pytest.raises(OSError):
        add()
    assert store.loads() == []
    monkeypatch.undo()
    add()
    assert store.loads() == ["a"] and store.tables()["firsts"].count() == ods["ods_orders"].select("user_id").distinct().count()


# Distinct sets

def test_distinct_members_of_any_range_of_days(spark):
    rng = random.Random(3)
    data = [(f"u{rng.randrange(90_000)}" if rng.random() > 0.01 else None, dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(60)))
            for _ in range(60_000)]
    data += [("hot", dt.date(2026, 1, 5))] * 5000
    df = spark.createDataFrame(data, "user string, day date")
    numbers = dense_numbers(df, "user", slice_rows=7000)
    known = len({u for u, _ in data if u})
    assert numbers.count() == known and numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first() == (1, known, known)
    daily = member_sets(with_numbers(df, numbers, "user"), ["day"]).cache()
    months = {r.month: r.users for r in distinct_over(daily, [F.month("day").alias("month")], "users").collect()}
    for month in (1, 2, 3):
        assert months.get(month, 0) == len({u for u, d in data if u and d.month == month})
    for low, high in ((0, 0), (3, 9), (10, 59)):
        first, last = (dt.date(2026, 1, 1) + dt.timedelta(x) for x in (low, high))
        some = daily.where(F.col("day").between(first, last))
        assert distinct_over(some, [F.lit(1).alias("g")], "users").first().users == len({u for u, d in data if u and first <= d <= last})
    assert distinct_over(daily.where("day > '2027-01-01'"), ["day"], "users").count() == 0
    daily.unpersist()


# Stored tables

def test_an_update_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"),
                                   F.when(F.col("id") % 7 < 6, F.concat(F.lit("m"), F.col("id") % 7)).alias("month"))
    tables.overwrite(base, path, "month")
    names = lambda: {p.parent.name + "/" + p.name for p in Path(path).rglob("*.parquet")}
    before, frame = names(), spark.read.parquet(path)
    derived = spark.createDataFrame([(7, 100), (8, None), (6, 60), (9999, 1)], "k long, v long")  # months m0, m1 and none
    expected = rows(tables.with_columns_from(frame, derived, "k").select("k", "v", "month"))
    assert tables.update_partitions(spark, path, derived, "k", "month") == 3
    assert rows(spark.read.parquet(path), "k", "v", "month") == expected
    touched = ("month=m0", "month=m1", "month=__HIVE")
    assert {n for n in before if not n.startswith(touched)} == {n for n in names() if not n.startswith(touched)}
    assert not {n for n in before if n.startswith(touched)} & names()
    assert tables.update_partitions(spark, path, derived.where("k = 9999"), "k", "month") == 0
    for odd in ({"k": F.col("k"), "month": F.lit("m")}, {"k": F.col("k"), "new": F.lit(1)}):
        with pytest.raises(ValueError):
            tables.update_partitions(spark, path, derived.select(*[c.alias(n) for n, c in odd.items()]), "k", "month")


def test_bucketed_tables_join_without_a_shuffle(spark, ods):
    names = {}
    for name in ("ods_orders", "ods_order_items"):
        names[name] = new_path(spark, name).rsplit("/", 1)[-1].replace("-", "_")
        tables.save_as_table(ods[name], names[name], "order_id", 4, new_path(spark, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, items = (spark.table(names[n]) for n in ("ods_orders", "ods_order_items"))
        joined = items.join(orders.select("order_id", "status"), "order_id")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        facts = dwd.build_dwd_order_items(items, orders, ods["ods_products"])
        assert "hashpartitioning(order_id" not in plan(facts)
        plain = dwd.build_dwd_order_items(ods["ods_order_items"], ods["ods_orders"], ods["ods_products"])
        assert rows(facts) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")


def test_appending_a_batch_twice_changes_nothing(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(10)
    assert tables.append(df, path, "2026-01-01") and not tables.append(df, path, "2026-01-01")
    assert tables.append(spark.range(5), path, "2026-01-02")
    (tmp_path / "t" / "batch=2026-01-02" / "_SUCCESS").unlink()  # cut off
    assert tables.append(spark.range(5), path, "2026-01-02")
    assert spark.read.parquet(path).count() == 15


def test_orders_without_a_user_do_not_count_as_users(spark, ods):
    orders = ods["ods_orders"].withColumn("user_id", F.when(F.col("order_id") != "O000000007", F.col("user_id")))
    facts = dwd.build_dwd_orders(orders, ods["ods_users"])
    assert facts.where("user_id IS NULL").count() == 1
    assert rows(quality.dq_first_orders(facts), "observed", "status") == [(0, "PASS")]


# The run

def test_a_run_that_ends_early_goes_on_where_it_stopped(spark, raw, tmp_path):
    expected = {n: rows(df) for n, df in pipeline.run_pipeline(spark, raw, str(tmp_path / "whole"), AS_OF).items()}
    done: list[str] = []

    class Killed(Exception):
        pass

    def kill_after(name):
        done.append(name)
        if len(done) % 3 == 0:
            raise Killed

    for _ in range(10):
        try:
            t = pipeline.run_pipeline(spark, raw, str(tmp_path / "wh"), AS_OF, after=kill_after)
            break
        except Killed:
            pass
    assert done == list(expected)  # each table was built once
    assert {n: rows(df) for n, df in t.items()} == expected
    assert not (tmp_path / "wh" / "_run").exists()
    again: list[str] = []
    pipeline.run_pipeline(spark, raw, str(tmp_path / "wh"), AS_OF, after=again.append)
    assert again == done  # a finished run is not gone on with


def test_changed_inputs_are_built_again(spark, raw, tmp_path):
    def stop(name):
        if name == "dwd_order_items":
            raise RuntimeError("stop")

    wh, done = str(tmp_path / "wh"), []
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, raw, wh, AS_OF, after=stop)
    pipeline.run_pipeline(spark, raw, wh, "2026-03-02", after=done.append)
    assert done[0] == "dwd_orders" and "ods_orders" not in done  # facts name the day they were asked for


def test_a_marker_names_its_owner_and_ends(spark, raw, tmp_path):
    wh = tmp_path / "wh"
    wh.mkdir()
    (wh / "_running").write_text("app-1 at noon")
    with pytest.raises(pipeline.AlreadyRunning, match="app-1 at noon"):
        pipeline.run_pipeline(spark, raw, str(wh), AS_OF)
    os.utime(wh / "_running", (1, 1))
    pipeline.run_pipeline(spark, raw, str(wh), AS_OF)
    assert not (wh / "_running").exists()


def test_build_figures_are_those_of_a_scan(spark, raw, tmp_path):
    t = pipeline.run_pipeline(spark, raw, str(tmp_path / "wh"), AS_OF)
    figures = {(r.table, r.metric): r.value for r in spark.read.parquet(str(tmp_path / "wh" / "build_metrics")).collect()}
    assert all(figures[n, "rows"] == df.count() for n, df in t.items())
    stats = dwd.dwd_orders_stats(t["dwd_orders"]).first().asDict()
    assert {m: figures["dwd_orders", m] for m in stats} == stats
    stats = dwd.dwd_items_stats(t["dwd_order_items"]).first().asDict()
    assert {m: figures["dwd_order_items", m] for m in stats} == stats
    for r in quality.dq_orders(t["ods_orders"]).collect():
        assert figures["ods_orders", r.check] == r.observed


def test_figures_of_a_partitioned_write(spark, tmp_path):
    seen = Observation("rows")
    df = spark.range(1000).withColumn("p", F.col("id") % 3)
    tables.overwrite(df, str(tmp_path / "t"), "p", seen, [F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")])
    assert seen.get == {"n": 1000, "s": 499500}
