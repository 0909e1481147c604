from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from seed import ITEMS, PRODUCTS, TRANSACTIONS

from tillwright import schemas
from tillwright.operators import quality

BY_ID = ("transaction_id",)
STAFF = [(5, "Test Employee", "Cashier", date(2025, 10, 27), None, 100000)]
WHEN = datetime(2025, 11, 1)


def report(spark, staff=(), products=(), transactions=(), items=()):
    make = spark.createDataFrame
    found = quality.store_report(
        make([*STAFF, *staff], schemas.EMPLOYEE),
        make([*PRODUCTS, *products], schemas.PRODUCTS),
        make([*TRANSACTIONS, *transactions], schemas.TRANSACTIONS),
        make([*ITEMS, *items], schemas.TRANSACTION_ITEM),
        BY_ID,
    )
    return {(r["table"], r["check"]): r.violations for r in found.collect() if r.violations}


def test_the_seed_breaks_nothing(spark):
    assert report(spark) == {}


def test_one_bad_row_per_constraint(spark):
    found = report(
        spark,
        staff=[(9, None, None, None, None, None)],
        products=[
            ("BS101", "Another name", 1),
            ("NEW1", "Đừng phê bình tôi", 1),
            ("NEW2", None, -1),
        ],
        transactions=[
            (1, 5, None, WHEN, "cash", None, 1, None),
            (6, 77, None, WHEN, "cheque", None, -5, None),
            (7, None, None, None, None, None, None, None),
        ],
        items=[(1, "THE001", 3), (99, "THE001", 1), (2, "nothing", 1)],
    )
    assert found == {
        ("employee", "employee_name not null"): 1,
        ("employee", "start_date not null"): 1,
        ("employee", "salary not null"): 1,
        ("products", "id unique"): 1,
        ("products", "product_name unique"): 1,
        ("products", "product_name not null"): 1,
        ("products", "price not negative"): 1,
        ("transactions", "key unique"): 1,
        ("transactions", "employee_id known"): 1,
        ("transactions", "payment_method in domain"): 1,
        ("transactions", "final_amount not negative"): 1,
        ("transactions", "employee_id not null"): 1,
        ("transactions", "created_at not null"): 1,
        ("transactions", "final_amount not null"): 1,
        ("transaction_item", "key unique"): 1,
        ("transaction_item", "transaction known"): 1,
        ("transaction_item", "product_id known"): 1,
    }


def test_loyalty_constraints(spark):
    make = spark.createDataFrame
    tiers = make(
        [("bronze", 0, Decimal(0), None), ("bad", -1, Decimal("100.01"), None),
         ("bad", None, None, None)],
        schemas.LOYALTY_TIER,
    )
    people = make([("c1", "An", WHEN), ("c2", None, WHEN)], schemas.CUSTOMER_INFO)
    points = make(
        [("c1", "bronze", -1, -1, WHEN), ("c9", "none", 0, 0, WHEN)], schemas.LOYALTY_CUSTOMER
    )
    found = quality.loyalty_report(tiers, people, points)
    assert {(r["table"], r["check"]): r.violations for r in found.collect() if r.violations} == {
        ("loyalty_tier", "min_point not null"): 1,
        ("loyalty_tier", "min_point not negative"): 1,
        ("loyalty_tier", "discount_percentage not null"): 1,
        ("loyalty_tier", "discount_percentage in range"): 1,
        ("loyalty_tier", "tier unique"): 1,
        ("customer_info", "name not null"): 1,
        ("loyalty_customer", "point not negative"): 1,
        ("loyalty_customer", "total_money_used not negative"): 1,
        ("loyalty_customer", "tier known"): 1,
        ("loyalty_customer", "customer known"): 1,
    }


def test_empty_tables_give_a_whole_report(spark):
    rules = {"name not null": quality.missing("name")}
    empty = spark.createDataFrame([], schemas.CUSTOMER_INFO)
    assert [tuple(r) for r in quality.row_checks(empty, "customer_info", rules).collect()] == [
        ("name not null", "customer_info", 0)
    ]


def test_violating_rows_name_their_rules(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, -1), ("b", None)], "name string, price int")
    found = quality.violations(
        df, {"named": quality.missing("name"), "priced": quality.outside("price", low=0)}
    )
    assert rows(found) == [(None, -1, ["named", "priced"])]


def test_domain_is_blind_to_case(spark):
    df = spark.createDataFrame([("CASH",), ("cheque",), (None,)], "m string")
    outside = quality.outside_domain("m", ("cash", "card"))
    assert [r.m for r in df.where(outside).collect()] == ["cheque"]


def test_masking_hides_id_and_name(spark):
    people = spark.createDataFrame([("0901234567", "Nguyen A1", WHEN)], schemas.CUSTOMER_INFO)
    plain = quality.masked_customers(people).first()
    keyed = quality.masked_customers(people, "secret").first()
    assert plain.name == "Xxxxxx Xn" and len(plain.id) == 64
    assert keyed.id != plain.id


def test_each_table_is_scanned_once(spark, tmp_path):
    tables = []
    for name, data, schema in (
        ("employee", STAFF, schemas.EMPLOYEE), ("products", PRODUCTS, schemas.PRODUCTS),
        ("transactions", TRANSACTIONS, schemas.TRANSACTIONS), ("items", ITEMS, schemas.TRANSACTION_ITEM),
    ):
        spark.createDataFrame(list(data), schema).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    found = quality.store_report(*tables, BY_ID)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4 and "Join" not in plan
    assert found.count() == 19


def test_keys_of_other_types_are_compared_as_what_they_point_to(spark):
    parent = spark.createDataFrame([(7,), (8,)], "id int")
    child = spark.createDataFrame([("7",), ("08",), ("x",), (None,)], "ref string")
    report = quality.constraint_report(
        [
            quality.Checked("p", parent, unique={"id": ["id"]}),
            quality.Checked("c", child, foreign={"known": (["ref"], "p", "id")}),
        ]
    )
    assert {r.check: r.violations for r in report.collect()} == {"id": 0, "known": 1}
