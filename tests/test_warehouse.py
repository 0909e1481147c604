from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T
from seed import items, products, transactions

from tillwright import schemas
from tillwright.functions.identity import row_identity
from tillwright.operators import dimensions, facts, ingest, keys, snapshots
from tillwright.plans import reports
from tillwright.sinks import warehouse

BY_ID = ("transaction_id",)
STORES = [("store-1", "1 Main St", "Hanoi", 5, date(2020, 1, 1))]
STAFF = [
    (5, "Test Employee", "Cashier", date(2025, 10, 27), None, 100000, "store-1"),
    (6, "Other Employee", "Clerk", date(2025, 1, 1), None, 90000, "store-9"),
]


def stores(spark):
    return spark.createDataFrame(STORES, schemas.STORE)


def staff(spark):
    return spark.createDataFrame(STAFF, T.StructType([*schemas.EMPLOYEE.fields, T.StructField("store_id", T.StringType())]))


@pytest.fixture
def dims(spark):
    s = dimensions.dim_store(stores(spark))
    people = spark.createDataFrame(
        [("0901234567", "An", datetime(2025, 1, 1)), ("0902345678", "Binh", None)],
        schemas.CUSTOMER_INFO,
    )
    points = spark.createDataFrame(
        [("0901234567", "gold", 1, 1, None)], schemas.LOYALTY_CUSTOMER
    )
    return (
        s,
        dimensions.dim_employee(staff(spark), s),
        dimensions.dim_customer(people, points),
        dimensions.dim_product(products(spark)),
    )


def seed_fact(spark, dims):
    wide = ingest.wide_orders(transactions(spark), items(spark), 3, BY_ID)
    return facts.fact_sales(wide.withColumn("store_name", F.lit("store-1")), *dims)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_keys_are_dense_and_do_not_depend_on_partitions(spark, n):
    members = spark.range(n).select(F.col("id").cast("string").alias("name"))
    first = {r.name: r.k for r in keys.assign_keys(members, ["name"], "k").collect()}
    again = keys.assign_keys(members.repartition(9), ["name"], "k").collect()
    assert sorted(first.values()) == list(range(1, n + 1))
    assert {r.name: r.k for r in again} == first


def test_new_members_go_on_after_the_largest_key(spark):
    old = keys.assign_keys(spark.range(10).withColumnRenamed("id", "n"), ["n"], "k")
    new = keys.assign_keys(
        spark.range(5, 15).withColumnRenamed("id", "n"), ["n"], "k", existing=old
    ).collect()
    assert sorted(r.n for r in new) == list(range(10, 15))
    assert sorted(r.k for r in new) == list(range(11, 16))


def test_unknown_members_get_key_zero(spark, dims):
    fact = seed_fact(spark, dims)
    known = {r.customer_id: r.customer_key for r in dims[2].collect()}
    by_transaction = dict(fact.select("transaction_id", "customer_key").distinct().collect())
    assert by_transaction == {
        1: known["0901234567"], 2: known["0902345678"], 3: 0, 4: 0, 5: 0
    }
    assert fact.where("product_key = 0 OR store_key = 0 OR employee_key = 0").count() == 0


def test_fact_grain_and_transaction_grain(spark, dims):
    fact = seed_fact(spark, dims)
    assert fact.count() == 11
    assert fact.select("sales_key").distinct().count() == 11
    assert fact.agg(F.sum("final_amount")).first()[0] == 9_120_000
    monthly = reports.sales_by_store_month(fact).orderBy("month").collect()
    assert [(r.month, r.transactions, r.revenue, r.points) for r in monthly] == [
        (202510, 4, 3_490_000, 349), (202511, 1, 320_000, 32)
    ]
    assert [(r.product_id, r.quantity) for r in reports.top_products(fact, 2).collect()] == [
        ("OEMTM421", 3), ("BS101", 2)
    ]


def test_dimensions_have_their_declared_columns(spark, dims):
    declared = (schemas.DIM_STORE, schemas.DIM_EMPLOYEE, schemas.DIM_CUSTOMER, schemas.DIM_PRODUCT)
    for dim, schema in zip(dims, declared):
        assert dim.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    calendar = dimensions.dim_date(spark, date(2025, 1, 1), date(2025, 1, 2))
    assert calendar.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DIM_DATE]


def test_both_ways_to_the_fact_agree(spark, dims, rows):
    heads = transactions(spark).withColumn("store_name", F.lit("store-1"))
    direct = facts.fact_of_items(heads, items(spark), *dims, keys=BY_ID)
    wide = seed_fact(spark, dims)
    assert direct.columns == wide.columns
    assert rows(direct) == rows(wide)


def test_null_points_count_as_zero(spark, dims):
    unset = transactions(spark).withColumn("point_changed", F.lit(None).cast("int"))
    wide = ingest.wide_orders(unset, items(spark), 3, BY_ID)
    wide = wide.withColumn("store_name", F.lit("store-1"))
    assert facts.fact_sales(wide, *dims).agg(F.sum("point_changed")).first()[0] == 0
    assert facts.fact_point_transaction(wide, dims[0], dims[2]).count() == 0


def test_point_fact(spark, dims):
    moved = transactions(spark).withColumn("store_name", F.lit("store-1"))
    fact = facts.fact_point_transaction(moved, dims[0], dims[2])
    assert sorted(r.points_changed for r in fact.collect()) == [32, 45, 56, 98, 150]
    assert {r.date_key for r in fact.collect()} == {
        20251028, 20251029, 20251030, 20251031, 20251101
    }


def test_facts_can_be_loaded_again(spark, dims, tmp_path):
    path = str(tmp_path / "fact")
    fact = seed_fact(spark, dims)
    warehouse.append_facts(fact.where("transaction_id < 4"), path)
    warehouse.append_facts(fact, path)
    warehouse.append_facts(fact, path)
    loaded = spark.read.parquet(path)
    assert loaded.count() == 11
    assert {r.month for r in loaded.select("month").collect()} == {202510, 202511}


def test_only_the_months_of_the_batch_are_read(spark, dims, tmp_path):
    path = str(tmp_path / "fact")
    fact = seed_fact(spark, dims)
    warehouse.append_facts(fact, path)
    november = fact.where("month = 202511")
    plan = warehouse.new_rows(november, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "202511" in plan


def test_newest_snapshot_wins(spark, rows):
    df = spark.createDataFrame(
        [("s", 1, "2025_01_01", "old"), ("s", 1, "2025_01_08", "new"), ("t", 1, "2025_01_01", "x")],
        "store_name string, transaction_id int, snapshot_date string, v string",
    )
    assert rows(snapshots.latest_per_key(df), "store_name", "v") == [("s", "new"), ("t", "x")]


def test_calendar(spark):
    days = dimensions.dim_date(spark, date(2024, 12, 29), date(2025, 1, 1)).collect()
    assert [(r.date_key, r.week, r.quarter, r.weekday_name) for r in days] == [
        (20241229, 52, 4, "Sunday"), (20241230, 1, 4, "Monday"),
        (20241231, 1, 4, "Tuesday"), (20250101, 1, 1, "Wednesday"),
    ]


def test_closed_stores_are_not_active(spark):
    df = stores(spark).withColumn("close_date", F.lit("2025-01-01").cast("date"))
    assert dimensions.dim_store(df).first().is_active == 0
    assert dimensions.dim_store(stores(spark)).first().is_active == 1


def test_employee_history(spark, rows):
    s = dimensions.dim_store(stores(spark))
    current = dimensions.dim_employee(staff(spark), s)
    changed = spark.createDataFrame(
        [
            (5, "Test Employee", "Manager", date(2025, 10, 27), None, 150000, "store-1"),
            (7, "New Employee", "Clerk", date(2025, 11, 1), None, 80000, "store-1"),
        ],
        staff(spark).schema,
    )
    after = dimensions.refresh_employees(current, changed, s)
    assert rows(after, "employee_id", "position", "is_current") == [
        (5, "Cashier", 0), (5, "Manager", 1), (6, "Clerk", 1), (7, "Clerk", 1)
    ]
    assert sorted(r.employee_key for r in after.collect()) == [1, 2, 3, 4]
    again = dimensions.refresh_employees(after, changed, s)
    assert rows(again) == rows(after)


def test_a_load_holds_each_key_once_with_nulls_and_without_dates(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    schema = (
        "store_name string, transaction_id int, product_id string, store_key long, date_key int, "
        "created_at timestamp, quantity int, month int"
    )
    one = ("s", 1, "A", 1, 20251101, datetime(2025, 11, 1), 1, 202511)
    null_store = (None, 2, "A", 0, 20251101, datetime(2025, 11, 1), 1, 202511)
    undated = ("s", 3, "A", 1, None, None, 1, None)
    batch = spark.createDataFrame([one, one, null_store, undated], schema)
    for _ in range(3):
        warehouse.append_facts(batch, path)
    loaded = rows(spark.read.parquet(path), "store_name", "transaction_id", "product_id")
    assert loaded == sorted([("s", 1, "A"), ("s", 3, "A"), (None, 2, "A")], key=repr)


def test_identities_never_run_into_each_other(spark):
    parts = [("a:b", "c"), ("a", "b:c"), ("a", None), (None, "a"), ("", "a"), (None, None), ("-", "1:a")]
    df = spark.createDataFrame(parts, "x string, y string")
    assert df.select(row_identity(F.col("x"), F.col("y"))).distinct().count() == len(parts)


def test_lookups_compare_in_the_type_of_the_dimension(spark, rows):
    members = spark.createDataFrame([(7, 1), (8, 2)], "employee_id int, employee_key long")
    given = spark.createDataFrame([(7.0,), (7.5,), (8.0,), (None,)], "employee_id double")
    found = keys.lookup_key(given.withColumnRenamed("employee_id", "e"), members, "e", "employee_id", "employee_key")
    assert rows(found) == sorted([(7.0, 1), (7.5, 0), (8.0, 2), (None, 0)], key=repr)
    texts = spark.createDataFrame([("8",), ("x",)], "e string")
    assert rows(keys.lookup_key(texts, members, "e", "employee_id", "employee_key")) == [("8", 2), ("x", 0)]


def test_a_member_listed_twice_has_one_key(spark, rows):
    listed = spark.createDataFrame([("p", 5), ("p", 4), ("q", 1)], "product_id string, price int")
    keyed = keys.assign_keys(listed, ["product_id"], "product_key")
    assert rows(keyed, "product_id", "price") == [("p", 4), ("q", 1)]
