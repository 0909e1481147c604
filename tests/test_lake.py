from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from seed import WIDE, items, products, transactions

from tillwright import schemas
from tillwright.plans import warehouse_load, weekly_ingest
from tillwright.session import shared_folder
from tillwright.operators.facts import dropped_transactions
from tillwright.operators.ingest import wide_orders
from tillwright.sinks.lake import export_table, write_csv, write_raw, write_staged
from tillwright.sources.snapshots import missing_inputs, raw_orders, require_inputs, staged
from tillwright.sources.tables import Store, partitioned_jdbc, read_csv, read_stores, read_table

AS_OF = datetime(2025, 11, 8, 11, 10)


@pytest.fixture
def pos(spark, tmp_path):
    path = str(tmp_path / "pos")
    transactions(spark).write.parquet(f"{path}/transactions")
    items(spark).write.parquet(f"{path}/transaction_item")
    return [Store("store-1", path), Store("store-2", path)]


def masters(spark):
    from test_warehouse import staff, stores

    people = spark.createDataFrame(
        [(t[2], "name", datetime(2025, 1, 1)) for t in transactions(spark).collect()],
        schemas.CUSTOMER_INFO,
    )
    none = spark.createDataFrame([], schemas.LOYALTY_CUSTOMER)
    return warehouse_load.Masters(stores(spark), staff(spark), products(spark), people, none)


def test_stores_are_read_side_by_side(spark, pos):
    both = read_stores(spark, pos, "transactions")
    assert both.groupBy("store_name").count().collect().__len__() == 2
    assert read_table(spark, pos[0], "transaction_item").count() == 11
    with pytest.raises(ValueError):
        read_stores(spark, [], "transactions")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, pos[0], "nothing")
    assert partitioned_jdbc("id", 1, 10, 4)["numPartitions"] == "4"


def test_ingest_writes_wide_orders_per_store(spark, pos, tmp_path):
    lake = str(tmp_path / "lake")
    for _ in range(2):
        assert weekly_ingest.run(spark, pos, lake, AS_OF) == "2025_11_08"
    raw = raw_orders(spark, lake, "2025_11_08")
    assert raw.count() == 10
    for store in ("store-1", "store-2"):
        got = {
            r.transaction_id: [r[c] for c in raw.columns if c[-2:] in ("_1", "_2", "_3")]
            for r in raw.where(F.col("store_name") == store).collect()
        }
        assert got == WIDE


def test_the_raw_zone_tells_what_the_fact_will_drop(spark, tmp_path, rows):
    some = items(spark).where("transaction_id <> 3")
    wide = wide_orders(transactions(spark), some, 3, ("transaction_id",))
    write_raw(wide.withColumn("store_name", F.lit("s")), str(tmp_path), "2025_11_08")
    raw = raw_orders(spark, str(tmp_path), "2025_11_08")
    assert rows(dropped_transactions(raw)) == [(5, 1)]


def test_a_store_without_old_orders_is_not_missing(spark, pos, tmp_path):
    lake = str(tmp_path / "lake")
    early = datetime(2025, 1, 1)
    weekly_ingest.run(spark, pos, lake, AS_OF)
    snapshot = weekly_ingest.stage(spark, pos, lake, early)
    assert missing_inputs(spark, lake, ["store-1", "store-2"], snapshot).count() == 0
    manifest = spark.read.parquet(f"{lake}/manifest").where(F.col("snapshot_date") == snapshot)
    assert {r.rows for r in manifest.collect()} == {0}
    assert staged(spark, lake, "transactions", snapshot).count() == 0


def test_missing_input_fails_the_build(spark, pos, tmp_path):
    lake = str(tmp_path / "lake")
    snapshot = weekly_ingest.stage(spark, pos, lake, AS_OF)
    with pytest.raises(FileNotFoundError, match="store-3/transaction_item, store-3/transactions"):
        weekly_ingest.build_raw(spark, ["store-1", "store-3"], lake, snapshot)


def test_warehouse_load_is_repeatable(spark, pos, tmp_path):
    lake, dw = str(tmp_path / "lake"), str(tmp_path / "dw")
    shared_folder(spark, "test")
    weekly_ingest.run(spark, pos[:1], lake, datetime(2025, 11, 5, 9, 14, 33))
    warehouse_load.load_dimensions(spark, dw, masters(spark))
    warehouse_load.load_facts(spark, dw, lake)
    assert spark.read.parquet(f"{dw}/fact_sales").count() == 2
    weekly_ingest.run(spark, pos[:1], lake, AS_OF, slots=None)
    for _ in range(2):
        warehouse_load.load_dimensions(spark, dw, masters(spark))
        warehouse_load.load_facts(spark, dw, lake)
    sales = spark.read.parquet(f"{dw}/fact_sales")
    assert sales.count() == 11 and sales.where("product_key = 0").count() == 0
    assert spark.read.parquet(f"{dw}/fact_point_transaction").count() == 5
    assert warehouse_load.dimension(spark, dw, "dim_product").count() == 11
    assert warehouse_load.dimension(spark, dw, "dim_employee").count() == 2


def test_exports_are_stamped_and_skip_empty_tables(spark, tmp_path):
    target = export_table(items(spark), str(tmp_path / "items"), AS_OF)
    assert target.endswith("items_20251108_111000.parquet")
    assert spark.read.parquet(target).count() == 11
    assert export_table(items(spark).where("false"), str(tmp_path / "none"), AS_OF) is None
    assert not (tmp_path / "none_20251108_111000.parquet").exists()


def test_csv_with_and_without_a_mark(spark, tmp_path, rows):
    write_csv(items(spark), str(tmp_path / "plain"))
    assert rows(read_csv(spark, str(tmp_path / "plain"), schemas.TRANSACTION_ITEM)) == rows(
        items(spark)
    )
    marked = tmp_path / "marked.csv"
    marked.write_text('id,product_name,price\nA,"vỉ 2 cái, ""to""",5\n', encoding="utf-8-sig")
    assert rows(read_csv(spark, str(marked), schemas.PRODUCTS)) == [("A", 'vỉ 2 cái, "to"', 5)]


def test_a_second_run_loses_what_a_store_no_longer_delivers(spark, rows, tmp_path):
    lake, stores = str(tmp_path / "lake"), ["a", "b"]
    make = lambda *data: spark.createDataFrame(list(data), "transaction_id int, store_name string")
    write_staged(make((1, "a"), (2, "b")), lake, "transactions", "2025_01_01", stores)
    write_staged(make((9, "b")), lake, "transactions", "2025_02_01", stores)
    write_staged(make((1, "a")), lake, "transactions", "2025_01_01", stores)
    assert rows(staged(spark, lake, "transactions", "2025_01_01"), "transaction_id") == [(1,)]
    assert rows(staged(spark, lake, "transactions", "2025_02_01"), "transaction_id") == [(9,)]
    missing = lambda s: rows(missing_inputs(spark, lake, stores, s, ["transactions"]), "store_name")
    assert missing("2025_01_01") == missing("2025_02_01") == []


def test_lost_and_unknown_inputs_are_missing(spark, rows, tmp_path):
    import shutil

    lake = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        require_inputs(spark, lake, ["a"], "2025_01_01")
    make = lambda *data: spark.createDataFrame(list(data), "transaction_id int, store_name string")
    write_staged(make((1, "a"), (2, "b")), lake, "transactions", "2025_01_01", ["a", "b", "c"])
    shutil.move(
        f"{lake}/staging/transactions/snapshot_date=2025_01_01/store_name=b", str(tmp_path / "lost")
    )
    gone = missing_inputs(spark, lake, ["a", "b", "c", "d"], "2025_01_01", ["transactions"])
    assert rows(gone, "store_name") == [("b",), ("d",)]


def test_a_basket_of_thousands_goes_through_ingest_and_load(spark, pos, tmp_path):
    path, lake, stock = str(tmp_path / "pos"), str(tmp_path / "lake"), str(tmp_path / "warehouse")
    more = spark.range(5000).selectExpr(
        "1 AS transaction_id", "format_string('x%05d', id) AS product_id", "1 AS quantity"
    )
    more.select([F.col(f.name).cast(f.dataType) for f in items(spark).schema]).write.mode(
        "append"
    ).parquet(f"{path}/transaction_item")
    snapshot = weekly_ingest.run(spark, pos[:1], lake, AS_OF)
    warehouse_load.load_dimensions(spark, stock, masters(spark))
    for _ in range(2):
        warehouse_load.load_facts(spark, stock, lake, snapshot)
    assert spark.read.parquet(f"{stock}/fact_sales").count() == 5011
    assert spark.read.parquet(f"{stock}/fact_point_transaction").count() == 5


def test_a_second_load_refreshes_attributes_and_keeps_keys(spark, rows, tmp_path, monkeypatch):
    from tillwright.sinks import manifest

    dw = str(tmp_path / "dw")
    first = masters(spark)
    warehouse_load.load_dimensions(spark, dw, first, transactions(spark))
    held = {r.product_id: r for r in warehouse_load.dimension(spark, dw, "dim_product").collect()}
    raised = first.products.where("id <> 'A'").withColumn("price", F.col("price") + 1)
    added = raised.limit(1).withColumns({"id": F.lit("new"), "product_name": F.lit("New")})
    later = first._replace(products=raised.unionByName(added))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(manifest, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            warehouse_load.load_dimensions(spark, dw, later)
    unchanged = warehouse_load.dimension(spark, dw, "dim_product")
    assert {r.product_id: r for r in unchanged.collect()} == held
    for _ in range(2):
        warehouse_load.load_dimensions(spark, dw, later)
        after = {r.product_id: r for r in warehouse_load.dimension(spark, dw, "dim_product").collect()}
        assert after.keys() == held.keys() | {"new"} and after["new"].product_key == len(held) + 1
        for name, row in held.items():
            assert after[name].product_key == row.product_key
            assert after[name].price == row.price + (name != "A")


def test_the_calendar_grows_and_keeps_its_holidays(spark, tmp_path):
    dw = str(tmp_path / "dw")
    at = lambda *days: spark.createDataFrame([(datetime(2025, 1, d),) for d in days], "created_at timestamp")
    warehouse_load.load_calendar(spark, dw, at(3, 5))
    held = warehouse_load.dimension(spark, dw, "dim_date")
    marked = held.withColumn("is_holiday", F.when(F.col("day") == 4, 1).otherwise(0).cast("smallint"))
    manifest_path = f"{dw}/dim_date"
    warehouse_load.write_version(marked, manifest_path)
    warehouse_load.load_calendar(spark, dw, at(1, 2))
    days = warehouse_load.dimension(spark, dw, "dim_date").orderBy("date_key").collect()
    assert [(r.day, r.is_holiday) for r in days] == [(1, 0), (2, 0), (3, 0), (4, 1), (5, 0)]


def test_refreshed_members_with_nulls_and_repeats(spark, rows):
    from tillwright.operators.dimensions import refresh_members

    held = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", None)], "k long, id string, v int")
    given = spark.createDataFrame([("a", None), ("c", 9), ("c", 8), ("d", 1), ("d", 1), (None, 4)], "id string, v int")
    after = refresh_members(held, given, "id", "k")
    assert rows(after) == [(1, "a", None), (2, "b", 6), (3, "c", 8), (4, "d", 1)]
    assert rows(refresh_members(after, given, "id", "k")) == rows(after)


def test_many_stores_are_one_scan(spark, tmp_path, rows):
    stores = []
    for n in range(40):
        path = str(tmp_path / f"pos {n}")
        wide = transactions(spark).limit(1).withColumns({"transaction_id": F.lit(n), "only_here": F.lit(n)})
        (wide if n == 7 else wide.drop("only_here")).coalesce(1).write.parquet(f"{path}/transactions")
        stores.append(Store(f"store-{n}", path))
    stores.append(Store("twin-of-3", stores[3].location + "/"))
    both = read_stores(spark, stores, "transactions")
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows(both, "store_name", "transaction_id", "only_here") == sorted(
        [(f"store-{n}", n, 7 if n == 7 else None) for n in range(40)] + [("twin-of-3", 3, None)], key=repr
    )
    declared = read_stores(spark, stores, "transactions", schemas.TRANSACTIONS)
    assert declared.count() == 41 and "only_here" not in declared.columns


def test_counts_come_with_the_write(spark, tmp_path):
    from tillwright.operators.facts import drop_counts

    some = items(spark).where("transaction_id <> 3")
    wide = wide_orders(transactions(spark), some, 1, ("transaction_id",), part="part")
    counts = write_raw(wide.withColumn("store_name", F.lit("s")), str(tmp_path), "2025_11_08", **drop_counts())
    assert counts == {"transactions": 5, "without_items": 1}
