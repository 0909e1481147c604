from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from tillwright import schemas
from tillwright.operators import loyalty
from tillwright.sinks import keyvalue
from tillwright.streaming import events, sales, state

START = datetime(2025, 11, 10)
VALUE = T.StructType().add("value", T.StringType())


def moved(customer, points, money, at, kind=schemas.POINT_UPDATED):
    return json.dumps(
        {
            "type": kind,
            "timestamp": int(at.timestamp() * 1000) if at else None,
            "payload": {
                "customer_id": customer, "store_id": "store-1", "points": points,
                "total_money_used": money, "last_updated": None,
            },
        }
    )


def named(customer, name, at, kind=schemas.CUSTOMER_UPDATED):
    payload = {"customer_id": customer, "store_id": "s", "name": name,
               "join_date": "2025-01-01T00:00:00.000000"}
    return json.dumps({"type": kind, "timestamp": int(at.timestamp() * 1000), "payload": payload})


@pytest.fixture
def topic(spark, tmp_path):
    """Batches of messages as a stream with one file per micro-batch."""

    def make(*batches):
        path = str(tmp_path / "topic")
        for batch in batches:
            frame = spark.createDataFrame([(m,) for m in batch], VALUE)
            events.write_topic(frame.coalesce(1), "parquet", {"path": path})
        return events.read_topic(
            spark, "parquet", {"path": path, "maxFilesPerTrigger": "1"}, VALUE
        )

    return make


def settle(spark, tmp_path, running, **more):
    path = str(tmp_path / "state")
    state.keep_state(running, path, str(tmp_path / "check"), **more).awaitTermination(120)
    return keyvalue.read_state(spark, path, ["customer_id"])


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_parse_splits_events_from_the_rest(spark, rows):
    messages = [
        moved("c1", 5, 10, at(0)), named("c2", "An", at(1)), "{broken", "",
        moved("c1", 5, 10, at(0), "order.placed"), moved(None, 5, 10, at(0)),
        moved("c1", None, 10, at(0)), moved("c1", 1, 1, None),
    ]
    split = events.parse_events(spark.createDataFrame([(m,) for m in messages], VALUE))
    assert rows(split.valid, "customer_id", "type", "ts") == [
        ("c1", schemas.POINT_UPDATED, at(0)), ("c2", schemas.CUSTOMER_UPDATED, at(1))
    ]
    assert sorted(r.reject_reason for r in split.rejected.collect()) == [
        "no customer id", "no totals", "not an event", "not an event", "not an event",
        "unknown type",
    ]


def test_envelope_round_trip(spark, rows):
    loyal = spark.createDataFrame(
        [("c1", "gold", 15, 111, datetime(2025, 11, 10, 8, 0, 0, 123000))],
        schemas.LOYALTY_CUSTOMER,
    )
    sent = events.point_events(loyal, "store-7")
    assert json.loads(sent.first().value) == {
        "type": "loyalty.point_updated",
        "timestamp": 1762761600123,
        "payload": {
            "customer_id": "c1", "store_id": "store-7", "points": 15, "total_money_used": 111,
            "last_updated": "2025-11-10T08:00:00.123000",
        },
    }
    assert rows(events.parse_events(sent).valid, "customer_id", "points") == [("c1", 15)]
    upserts = spark.createDataFrame(
        [("c1", "An", None, True, START), ("c2", "B", START, False, START)],
        "id string, name string, join_date timestamp, created boolean, requested_at timestamp",
    )
    kinds = [json.loads(r.value) for r in events.customer_events(upserts, "s").collect()]
    assert [k["type"] for k in kinds] == ["customer.created", "customer.updated"]
    assert kinds[0]["payload"] == {
        "customer_id": "c1", "store_id": "s", "name": "An", "join_date": None
    }


def test_newest_totals_win_in_any_order(spark, rows, topic, tmp_path):
    stream = events.parse_events(
        topic(
            [moved("c1", 10, 100, at(1)), moved("c2", 1, 1, at(0))],
            [moved("c1", 30, 300, at(3)), moved("c1", 30, 300, at(3))],
            [moved("c1", 20, 200, at(2)), named("c1", "An", at(9))],
        )
    ).valid
    kept = settle(spark, tmp_path, state.latest_points(stream))
    assert rows(kept) == [("c1", 30, 300), ("c2", 1, 1)]


def test_newest_customer_fields_win(spark, rows, topic, tmp_path):
    stream = events.parse_events(
        topic(
            [named("c1", "An", at(0), schemas.CUSTOMER_CREATED)],
            [named("c1", "Anh", at(2)), named("c2", "Binh", at(1))],
            [named("c1", "late", at(1))],
        )
    ).valid
    kept = settle(spark, tmp_path, state.latest_customers(stream))
    assert rows(kept) == [
        ("c1", "Anh", datetime(2025, 1, 1)), ("c2", "Binh", datetime(2025, 1, 1))
    ]


def test_accrual_stream_equals_the_batch_and_ignores_repeats(spark, rows, topic, tmp_path):
    first = [moved(f"c{i % 7}", i, i * 10, at(i)) for i in range(40)]
    second = [moved(f"c{i % 7}", i, i * 10, at(i)) for i in range(30, 80)]
    stream = events.parse_events(topic(first, second, first[:5] + second[:5])).valid
    tiers = spark.createDataFrame(
        [("bronze", 0, None, None), ("silver", 450, None, None)], schemas.LOYALTY_TIER
    )
    path = str(tmp_path / "accrual")
    state.accrue_once(stream, path, str(tmp_path / "check")).awaitTermination(120)
    kept = loyalty.assign_tiers(state.accrued_totals(spark, path), tiers)
    requests = spark.createDataFrame(
        [(f"c{i % 7}", i, i * 10, at(i)) for i in range(80)],
        "customer_id string, earned_point int, amount long, requested_at timestamp",
    )
    none = spark.createDataFrame([], schemas.LOYALTY_CUSTOMER)
    batch = loyalty.assign_tiers(loyalty.accrue_points(none, requests), tiers)
    columns = ("customer_id", "point", "total_money_used", "last_updated", "tier")
    assert rows(kept, *columns) == rows(batch, *columns)


def test_late_and_same_instant_purchases_count_and_repeats_never(spark, rows, topic, tmp_path):
    late = moved("c", 1, 10, at(-60 * 24 * 90))
    stream = events.parse_events(
        topic(
            [moved("c", 2, 20, at(0)), moved("c", 3, 30, at(0)), moved("d", 1, 1, at(1))],
            [moved("c", 2, 20, at(0)), moved("d", 1, 1, at(60 * 24 * 30))],
            [late, moved("c", 3, 30, at(0)), late, named("c", "An", at(5))],
            [late],
        )
    ).valid
    path = str(tmp_path / "accrual")
    state.accrue_once(stream, path, str(tmp_path / "check")).awaitTermination(120)
    assert rows(state.accrued_totals(spark, path)) == [
        ("c", 6, 60, at(0)), ("d", 2, 2, at(60 * 24 * 30))
    ]


def test_a_batch_run_again_adds_nothing(spark, rows, tmp_path):
    schema = "customer_id string, type string, ts timestamp, points long, total_money_used long"
    make = lambda *data: spark.createDataFrame(list(data), schema)
    one, two = ("c", "x", at(0), 1, 10), ("c", "x", at(1), 2, 20)
    log = str(tmp_path / "seen")
    for batch_id, batch, want in ((0, (one, one), 1), (1, (one, two), 1), (1, (one, two), 1), (2, (two,), 0)):
        fresh = state.fresh_events(make(*batch), log, batch_id).persist()
        assert fresh.count() == want
        state._note(fresh, log, batch_id)


def test_state_log_can_be_compacted_and_batches_replaced(spark, rows, tmp_path):
    log, small = str(tmp_path / "log"), str(tmp_path / "small")
    make = lambda *data: spark.createDataFrame(list(data), "customer_id string, points int")
    keyvalue.put_batch(make(("a", 1), ("b", 1)), log, 0)
    keyvalue.put_batch(make(("a", 9)), log, 1)
    keyvalue.put_batch(make(("a", 2)), log, 1)
    assert rows(keyvalue.read_state(spark, log, ["customer_id"])) == [("a", 2), ("b", 1)]
    keyvalue.compact(spark, log, ["customer_id"], small)
    keyvalue.put_batch(make(("b", 5)), small, 2)
    assert rows(keyvalue.read_state(spark, small, ["customer_id"])) == [("a", 2), ("b", 5)]


def test_orders_stream_into_facts_once(spark, topic, tmp_path):
    def order(n, **more):
        return json.dumps(
            {
                "transaction_id": f"t{n}", "customer_id": "c", "employee_id": "5",
                "created_at": f"2025-11-{n:02d}T00:00:00",
                "items": [{"product_id": p, "quantity": 1, "unit_price": 2} for p in "AB"],
                **more,
            }
        )

    stream = topic([order(1), order(2, items=[])], [order(1), order(3)], ["{broken"])
    paths = {n: str(tmp_path / n) for n in ("facts", "orders", "rejects", "checkpoint")}

    def to_facts(valid):
        return valid.select(
            F.lit("s").alias("store_name"), "transaction_id", F.inline("items"), "created_at",
            F.lit(1).alias("store_key"), F.lit(1).alias("date_key"),
            F.lit(202511).alias("month"),
        )

    sales.load_orders(stream, to_facts, **paths).awaitTermination(120)
    loaded = spark.read.parquet(paths["facts"])
    assert sorted((r.transaction_id, r.product_id) for r in loaded.collect()) == [
        ("t1", "A"), ("t1", "B"), ("t3", "A"), ("t3", "B")
    ]
    rejected = spark.read.parquet(paths["rejects"])
    assert sorted(r.reject_reason for r in rejected.collect()) == [
        "no items", "no transaction id"
    ]
