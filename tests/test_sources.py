"""Files, stored tables, generated tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from micro import ORDERS, USERS, raw_tables, rows
from pyspark.sql import functions as F

from basketline import fixed_values as fv
from basketline.operators.summaries import database_census
from basketline.schemas import PRIMARY_KEYS, SCHEMAS, conform
from basketline.sources import files, generate, tables
from basketline.storage import materialize, path_exists, shared_folder

HEADER = "order_id,user_id,total_amount,status,item_count,create_time,pay_time\n"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="orders.csv"):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)
    return write


def test_csv_with_empty_malformed_and_date_only_times(spark, csv):
    path = csv(HEADER
               + "O1,U1,10.50,paid,1,2026-01-01 10:00:00,2026-01-01 10:05:00\n"
               + "O2,U1,20.00,cancelled,1,2026-01-02 00:00:00,\n"
               + "O3,,30.00,paid,1,not a time,  \n"
               + "O4,U2,,paid,,2026-02-30 00:00:00,2026-01-03\n")
    df = files.read_csv(spark, path, SCHEMAS["ods_orders"])
    assert df.schema == SCHEMAS["ods_orders"]
    at = lambda *a: dt.datetime(2026, *a)
    assert rows(df, "order_id", "user_id", "total_amount", "create_time", "pay_time") == [
        ("O1", "U1", D("10.50"), at(1, 1, 10), at(1, 1, 10, 5)), ("O2", "U1", D("20.00"), at(1, 2), None),
        ("O3", None, D("30.00"), None, None), ("O4", "U2", None, None, at(1, 3)),
    ]


def test_csv_header_must_match(spark, csv):
    path = csv("user_id,order_id,total_amount,status,item_count,create_time,pay_time\nU1,O1,1,paid,1,,\n")
    with pytest.raises(Exception):
        files.read_csv(spark, path, SCHEMAS["ods_orders"]).collect()


def test_csv_with_named_date_columns(spark, csv):
    schema = SCHEMAS["ods_orders"]
    path = csv(HEADER + "O1,U1,1,paid,1,2026-01-01 10:00:00,2026-01-01 10:00:01\n")
    df = files.read_csv(spark, path, schema, parse_dates=["create_time"])
    assert rows(df, "create_time") == [(dt.datetime(2026, 1, 1, 10),)]


def test_csv_keeps_utf8_text(spark, csv):
    path = csv("user_id,username,gender,age,city,phone,level,register_date\nU1,😀,M,1,北京,1,Gold,2026-01-01\n")
    assert rows(files.read_csv(spark, path, SCHEMAS["ods_users"]), "username", "city", "register_date") == [
        ("😀", "北京", dt.date(2026, 1, 1))]


def test_parse_temporal_goes_by_column_name(spark):
    df = spark.createDataFrame([("2026-01-01", "x", "2026-01-01")], "update_date string, TIME_x string, other string")
    parsed = files.parse_temporal(df)
    assert dict(parsed.dtypes) == {"update_date": "timestamp_ntz", "TIME_x": "timestamp_ntz", "other": "string"}
    assert rows(parsed) == [(dt.datetime(2026, 1, 1), None, "2026-01-01")]


def test_missing_file_loads_nothing_but_missing_folder_raises(spark, csv, tmp_path, capsys):
    csv(HEADER + "O1,U1,1,paid,1,2026-01-01 10:00:00,\n")
    loaded = tables.load_ods(spark, str(tmp_path))
    assert {n: df.count() for n, df in loaded.items()} == {
        "ods_users": 0, "ods_products": 0, "ods_orders": 1, "ods_order_items": 0}
    assert "users.csv" in capsys.readouterr().out
    assert loaded["ods_users"].schema == SCHEMAS["ods_users"]
    with pytest.raises(FileNotFoundError):
        tables.load_ods(spark, str(tmp_path / "absent"))


def test_csv_round_trip(spark, tmp_path):
    t = raw_tables(spark)
    files.write_csv(t["ods_orders"], str(tmp_path / "orders.csv"))
    back = files.read_csv(spark, str(tmp_path / "orders.csv"), SCHEMAS["ods_orders"])
    assert rows(back) == rows(t["ods_orders"])


def test_conform_rounds_and_orders_columns(spark):
    df = spark.createDataFrame([(D("1.005"), "P1", "O1", 2, D("3.00"))],
                               "unit_price decimal(10,3), product_id string, order_id string, quantity bigint, "
                               "amount decimal(12,2)")
    assert rows(conform(df, "ods_order_items")) == [("O1", "P1", 2, D("1.01"), D("3.00"))]
    big = df.withColumn("quantity", F.lit(5_000_000_000))
    with pytest.raises(Exception):
        conform(big, "ods_order_items").collect()
    assert rows(conform(big, "ods_order_items", lenient=True), "quantity") == [(None,)]


def test_overwrite_append_read(spark, tmp_path):
    path = str(tmp_path / "wh" / "t")
    df = spark.range(10).select("id", (F.col("id") % 3).alias("part"))
    for _ in range(2):
        tables.overwrite(df, path, "part")
    read = tables.read_table(spark, str(tmp_path / "wh"), "t")
    assert rows(read.select("id", "part")) == rows(df)
    assert (tmp_path / "wh" / "t" / "part=1").is_dir()
    plain = str(tmp_path / "wh" / "u")
    tables.overwrite(df, plain)
    tables.append(df, plain)
    assert tables.read_table(spark, str(tmp_path / "wh"), "u").count() == 20


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.overwrite(broken, path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    tables.overwrite(spark.read.parquet(path).where("id > 0"), path)  # may read what it replaces
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_catalog_tables(spark):
    tables.ensure_namespace(spark, "shop")
    tables.ensure_namespace(spark, "shop")
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    tables.save_as_table(left, "shop.l", "k", 4)
    tables.save_as_table(right, "shop.r", "k", 4)
    assert rows(database_census(spark, "shop")) == [("l", 100), ("r", 50)]
    tables.ensure_namespace(spark, "empty")
    assert database_census(spark, "empty").count() == 0
    joined = spark.table("shop.l").hint("merge").join(spark.table("shop.r"), "k")
    assert joined.count() == 50
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_update_from_derived_table(spark):
    base = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, x int, y int")
    derived = spark.createDataFrame([("a", None, 9)], "k string, x int, z int")
    assert rows(tables.with_columns_from(base, derived, "k")) == [("a", None, 1, 9), ("b", 2, 2, None)]


def test_shared_folder_and_materialize(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5).withColumn("x", F.rand())
    stored = materialize(df, "t")
    assert rows(stored) == rows(stored) and stored.count() == 5
    file = stored.inputFiles()[0]
    assert shared_folder(spark) in file and path_exists(spark, file)


AS_OF = "2026-03-01"


@pytest.fixture(scope="module")
def generated(spark):
    ids = generate.numbers(spark, 3000)
    return {
        "users": generate.gen_users(generate.numbers(spark, 5000), as_of=AS_OF).cache(),
        "products": generate.gen_products(generate.numbers(spark, 2000), as_of=AS_OF).cache(),
        "orders": generate.gen_orders(ids, 500, 40, as_of=AS_OF).cache(),
        "order_items": generate.gen_order_items(ids, 40).cache(),
    }


def test_generated_keys_are_unique_and_schemas_declared(generated):
    for name, df in generated.items():
        key = PRIMARY_KEYS[f"ods_{name}"]
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in SCHEMAS[f"ods_{name}"]]
        assert df.select(key).distinct().count() == df.count()
    assert generated["orders"].count() == 3000


def test_generated_users(generated):
    users = generated["users"]
    share = {r.level: r["count"] / 5000 for r in users.groupBy("level").count().collect()}
    assert [share[v] for v in fv.USER_LEVELS] == pytest.approx(fv.USER_LEVEL_WEIGHTS, abs=0.025)
    assert users.select("city").distinct().count() == 24
    assert users.where("age < 16 or age > 67 or register_date > date'2026-03-01' "
                       "or register_date < date'2024-03-01'").count() == 0
    assert rows(users.select("user_id").orderBy("user_id").limit(1)) == [("U00000001",)]


def test_generated_products(generated):
    stats = {r.category: r for r in generated["products"].groupBy("category").agg(
        F.min("price").alias("lo"), F.max("price").alias("hi"), F.mean(F.log("price")).alias("m")).collect()}
    import math
    for name, (_, _, (low, high)) in fv.PRODUCT_CATEGORIES.items():
        assert low <= stats[name].lo and stats[name].hi <= high
        assert stats[name].m == pytest.approx((math.log(low) + math.log(high)) / 2, abs=0.4)


def test_generated_orders_agree_with_their_items(generated):
    orders, items = generated["orders"], generated["order_items"]
    sums = items.groupBy("order_id").agg(F.sum("amount").alias("s"), F.count("*").alias("n"))
    joined = orders.join(sums, "order_id", "left")
    assert joined.where("total_amount <> s or item_count <> n or s is null").count() == 0
    assert orders.where("(status = 'cancelled') <> (pay_time is null)").count() == 0
    assert items.where("amount <> unit_price * quantity or unit_price < 5 or unit_price > 5000").count() == 0
    share = {r.n: r["count"] / 3000 for r in sums.groupBy("n").count().collect()}
    assert [share[n] for n in fv.ITEM_COUNTS] == pytest.approx([0.4, 0.3, 0.15, 0.1, 0.05], abs=0.03)
    share = {r.status: r["count"] / 3000 for r in orders.groupBy("status").count().collect()}
    assert [share[s] for s in fv.ORDER_STATUSES] == pytest.approx(fv.STATUS_WEIGHTS, abs=0.03)


def test_generation_repeats(spark, generated):
    again = generate.gen_orders(generate.numbers(spark, 3000).repartition(7), 500, 40, as_of=AS_OF)
    assert rows(again) == rows(generated["orders"])
    other = generate.gen_orders(generate.numbers(spark, 3000), 500, 40, seed=1, as_of=AS_OF)
    assert rows(other) != rows(generated["orders"])
