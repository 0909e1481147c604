from __future__ import annotations

import random
from datetime import datetime

import pytest

from tillwright import schemas
from tillwright.operators import loyalty

T0, T1, T2 = (datetime(2025, 11, d) for d in (1, 2, 3))


def people(spark, *data):
    return spark.createDataFrame(list(data), schemas.CUSTOMER_INFO)


def points(spark, *data):
    return spark.createDataFrame(list(data), schemas.LOYALTY_CUSTOMER)


def test_profiles(spark, rows):
    known = people(spark, ("c1", "An", T0), ("c2", "Binh", T0))
    loyal = points(spark, ("c1", "gold", 5, 10, T1), ("c9", None, 1, 1, T1))
    assert rows(loyalty.customer_profiles(known, loyal)) == [
        ("c1", "An", T0, "gold", 5, 10, T1), ("c2", "Binh", T0, None, None, None, None)
    ]
    asked = spark.createDataFrame([("c1",), ("c1",), ("c9",)], "id string")
    found, missing = loyalty.profiles_requested(asked, known, loyal)
    assert rows(found, "id") == [("c1",)] and rows(missing) == [("c9",)]


def test_upsert(spark, rows):
    known = people(spark, ("c1", "An", T0), ("c2", "Binh", T0))
    requests = spark.createDataFrame(
        [("c1", "Anh", None, T1), ("c3", "Chi", None, T1), ("c3", "Chi B", T0, T2),
         ("c4", "Dung", T0, T2)],
        "id string, name string, join_date timestamp, requested_at timestamp",
    )
    assert rows(loyalty.upsert_customers(known, requests)) == [
        ("c1", "Anh", T0, False), ("c2", "Binh", T0, None),
        ("c3", "Chi B", T1, True), ("c4", "Dung", T0, True),
    ]


def test_requests_without_id_or_name_are_rejected(spark, rows):
    requests = people(spark, ("c1", "An", None), (None, "B", None), ("", "B", None), ("c2", None, None))
    split = loyalty.judge_customer_requests(requests)
    assert rows(split.valid, "id") == [("c1",)]
    assert sorted(r.reject_reason for r in split.rejected.collect()) == [
        "missing id", "missing id", "missing name"
    ]


def test_accrual(spark, rows):
    before = points(spark, ("c1", "gold", 5, 10, T0), ("c2", None, None, None, None))
    requests = spark.createDataFrame(
        [("c1", 10, 100, T1), ("c1", None, 1, T2), ("c2", 7, 70, T1), ("c3", 1, None, T1)],
        "customer_id string, earned_point int, amount long, requested_at timestamp",
    )
    assert rows(loyalty.accrue_points(before, requests)) == [
        ("c1", "gold", 15, 111, T2), ("c2", None, 7, 70, T1), ("c3", None, 1, 0, T1)
    ]


def test_tiers(spark, rows):
    tiers = spark.createDataFrame(
        [("bronze", 10, None, None), ("silver", 500, None, None), ("gold", 100_000, None, None),
         ("never", None, None, None)],
        schemas.LOYALTY_TIER,
    )
    held = [9, 10, 499, 500, 99_999, 100_000, 2_000_000_000, -5, None]
    want = [None, "bronze", "bronze", "silver", "silver", "gold", "gold", None, None]
    loyal = points(spark, *[(f"c{i}", "old", p, 0, None) for i, p in enumerate(held)])
    got = loyalty.assign_tiers(loyal, tiers)
    assert rows(got, "customer_id", "tier") == [(f"c{i}", t) for i, t in enumerate(want)]
    assert set(got.columns) == set(loyal.columns)


def test_many_tiers(spark, rows):
    rng = random.Random(3)
    steps = [(f"t{p}", p, None, None) for p in rng.sample(range(0, 3_000_000), 60)]
    tiers = spark.createDataFrame(steps, schemas.LOYALTY_TIER)
    held = [rng.randrange(0, 4_000_000) for _ in range(500)]
    loyal = points(spark, *[(f"c{i}", None, p, 0, None) for i, p in enumerate(held)])
    best = [max((s[1], s[0]) for s in [(None, -1), *steps] if s[1] <= p)[1] for p in held]
    want = sorted(((f"c{i}", t) for i, t in enumerate(best)), key=repr)
    assert rows(loyalty.assign_tiers(loyal, tiers), "customer_id", "tier") == want


def test_no_tiers_at_all(spark, rows):
    loyal = points(spark, ("c1", "old", 5, 0, None))
    none = spark.createDataFrame([], schemas.LOYALTY_TIER)
    assert rows(loyalty.assign_tiers(loyal, none), "customer_id", "tier") == [("c1", None)]
