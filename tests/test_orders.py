from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from seed import items, products

from tillwright.operators import lookups, orders
from tillwright.sinks.orders import save_orders, saved_orders
from tillwright.sources.order_files import number_or_text, read_order_files


def document(**changes):
    order = {
        "transaction_id": "t1",
        "customer_id": "c1",
        "employee_id": "e1",
        "created_at": "2025-11-10T08:00:00",
        "items": [
            {"product_id": "A", "quantity": 2, "unit_price": 10.5},
            {"product_id": "B", "quantity": 1, "unit_price": 100000},
        ],
        "discount": 1.25,
        "payment_method": "CREDIT_CARD",
    }
    order.update(changes)
    return json.dumps({k: v for k, v in order.items() if v is not ...})


def frame(spark, *documents):
    return spark.createDataFrame([(d,) for d in documents], "value string")


def test_orders_become_headers_and_items(spark, rows):
    normal = orders.normalise_orders(frame(spark, document()))
    header = normal.headers.first()
    assert header.total_amount == Decimal("100021.00")
    assert header.final_amount == Decimal("100019.75")
    assert header.point_changed == 10
    assert header.payment_method == "card"
    assert rows(normal.items) == [
        ("t1", "A", 2, Decimal("10.50")), ("t1", "B", 1, Decimal("100000.00"))
    ]
    assert normal.rejected.count() == 0


def test_defaults_apply_to_missing_fields(spark):
    header = orders.normalise_orders(
        frame(spark, document(discount=..., payment_method=...))
    ).headers.first()
    assert header.discount == 0 and header.payment_method == "cash"
    assert header.final_amount == Decimal("100021.00")


@pytest.mark.parametrize(
    "spelling, stored",
    [("CASH", "cash"), ("CREDIT_CARD", "card"), ("E_WALLET", "e-wallet"), ("card", "card"),
     (" e-wallet ", "e-wallet")],
)
def test_every_spelling_of_a_payment_is_stored_alike(spark, spelling, stored):
    header = orders.normalise_orders(frame(spark, document(payment_method=spelling))).headers
    assert header.first().payment_method == stored


@pytest.mark.parametrize(
    "text, reason",
    [
        (document(items=[]), "no items"),
        (document(items=None), "no items"),
        (document(items=[{"product_id": "A", "quantity": 1}]), "incomplete item"),
        (document(payment_method="cheque"), "unknown payment method"),
        (document(transaction_id=...), "no transaction id"),
        (document(customer_id=...), "no customer id"),
        (document(employee_id=None), "no employee id"),
        (document(created_at="yesterday"), "no creation time"),
        ("{broken", "no transaction id"),
    ],
)
def test_bad_orders_are_rejected_with_a_reason(spark, text, reason):
    normal = orders.normalise_orders(frame(spark, text, document()))
    assert [(r.document, r.reject_reason) for r in normal.rejected.collect()] == [(text, reason)]
    assert normal.headers.count() == 1


def test_row_totals_equal_nested_totals(spark, rows):
    docs = frame(spark, document(), document(transaction_id="t2", discount=10))
    for mode in ("amount", "percent"):
        nested = orders.nested_totals(orders.parse_orders(docs), mode)
        flat = orders.item_totals(
            orders.parse_orders(docs).drop("items"),
            orders.order_items(orders.parse_orders(docs)),
            discount_mode=mode,
        )
        columns = ("transaction_id", "total_amount", "final_amount", "point_changed")
        assert rows(nested, *columns) == rows(flat, *columns)
    with pytest.raises(ValueError):
        orders.nested_totals(orders.parse_orders(docs), "half")


def test_items_without_a_price_take_the_product_price(spark):
    own = items(spark).withColumn(
        "unit_price", F.when(F.col("product_id") == "BS101", Decimal("1.00"))
    )
    priced = {r.product_id: r.unit_price for r in orders.priced_items(own, products(spark)).collect()}
    assert priced["BS101"] == 1 and priced["SC_MS1947"] == 299000


def test_price_lookup(spark, rows):
    p = products(spark)
    want = [("BS101", "Hộp 12 cái Bút sơn Toyo SA101", 127000.0)]
    assert rows(lookups.prices_for(p, ["BS101", "none"])) == want
    assert rows(lookups.prices_for(p, [])) == []
    many = ["BS101"] + [f"x{i}" for i in range(2000)]
    assert rows(lookups.prices_for(p, many)) == want
    asked = spark.createDataFrame([("BS101",), ("BS101",)], "id string")
    assert rows(lookups.prices_for(p, asked)) == want


def test_first_rows_and_single_rows(spark, rows):
    p = products(spark)
    assert [r[0] for r in rows(lookups.first_rows(p, 3, "id"), "id")] == [
        "BS101", "ERKLT080-10", "OEMKS224"
    ]
    assert lookups.row_by_key(p, F.col("id") == "THE001").count() == 1


def test_numbers_and_text_are_told_apart(spark):
    df = spark.createDataFrame([(" 12.5 ",), ("x1",), (None,)], "v string")
    number, text = number_or_text(F.col("v"))
    assert [tuple(r) for r in df.select(number, text).collect()] == [
        (12.5, "12.5"), (None, "x1"), (None, None)
    ]


def test_a_huge_order_keeps_its_amounts(spark):
    huge = document(items=[{"product_id": "A", "quantity": 5_000_000_000, "unit_price": 90000}])
    header = orders.normalise_orders(frame(spark, huge)).headers.first()
    assert header.total_amount == 450_000_000_000_000
    assert header.point_changed == 44_999_999_999


def test_order_files_keep_commas_inside_json(spark, tmp_path):
    path = tmp_path / "orders.csv"
    cells = '[{""product_id"":""A,1"",""quantity"":2,""unit_price"":3},' \
            '{""product_id"":""B"",""quantity"":1,""unit_price"":4.5}]'
    path.write_text(
        "transaction_id,customer_id,employee_id,created_at,items,discount,payment_method\n"
        f't1,c1,5,2025-11-10T08:00:00,"{cells}",2,CASH\n'
        f't2,c2,6,2025-11-11T08:00:00,"{cells}",none,\n',
        encoding="utf-8-sig",
    )
    read = read_order_files(spark, str(path)).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in read] == ["t1", "t2"]
    assert [(i.product_id, i.quantity) for i in read[0]["items"]] == [("A,1", 2), ("B", 1)]
    assert [r.discount for r in read] == [Decimal("2.00"), None]


def test_saved_orders_are_seen_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "orders")
    normal = orders.normalise_orders(frame(spark, document()))
    save_orders(normal.headers, normal.items, path, "7")
    # A batch that failed half way: rows, but no marker.
    normal.headers.write.parquet(f"{path}/transactions/batch_id=8")
    headers, lines = saved_orders(spark, path)
    assert headers.count() == 1 and lines.count() == 2
    save_orders(normal.headers, normal.items, path, "8")
    headers, lines = saved_orders(spark, path)
    assert headers.count() == 2 and lines.count() == 4


def test_uploads_that_cannot_be_read_are_told_why(spark):
    from tillwright.sources.order_files import UPLOAD, split_uploads

    good = '[{"product_id": "A", "quantity": "2", "unit_price": 3.5}]'
    rows_in = {
        "whole": (good, "2025-11-10T08:00:00", " 2.5 "),
        "cut off": ('[{"product_id"', "2025-11-10T08:00:00", None),
        "no list": ('{"quantity": 1}', "2025-11-10T08:00:00", None),
        "words": ('[{"product_id": "A", "quantity": "two", "unit_price": 1}]', "2025-11-10T08:00:00", None),
        "no price": ('[{"product_id": "A", "quantity": 2}]', "2025-11-10T08:00:00", None),
        "when": (good, "soon", None),
        "rebate": (good, "2025-11-10T08:00:00", "5 %"),
        "blank": ("", "", ""),
    }
    raw = spark.createDataFrame([(n, "c", "5", at, items, off, None) for n, (items, at, off) in rows_in.items()], UPLOAD)
    typed, refused = split_uploads(raw)
    assert {r.transaction_id: r.reject_reason for r in refused.collect()} == {
        "cut off": "unreadable items", "no list": "unreadable items", "words": "items without numbers",
        "no price": "items without numbers", "when": "unreadable time", "rebate": "unreadable discount",
    }
    found = {r.transaction_id: r for r in typed.collect()}
    assert found.keys() == {"whole", "blank"} and found["blank"]["items"] is None
    assert found["whole"]["items"][0].quantity == 2 and found["whole"].discount == Decimal("2.50")
