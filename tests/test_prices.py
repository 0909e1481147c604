"""Prices as of the time of a line, against a search for each line."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tillwright.operators.prices import priced_as_of

START = datetime(2025, 1, 1)
LINES = "product_id string, created_at timestamp, unit_price decimal(18,2), n int, price string"
PRICES = "product_id string, valid_from timestamp, price decimal(18,2)"


def brute(lines, prices):
    out = []
    for product, at, own, n, other in lines:
        known = [(start, price) for p, start, price in prices if None not in (p, start, price) and p == product]
        valid = [x for x in known if at is not None and x[0] <= at]
        if own is not None:
            out.append((product, at, n, other, own, "own"))
        elif product is None or at is None:
            out.append((product, at, n, other, None, "no time" if product else "no product"))
        else:
            out.append((product, at, n, other, max(valid)[1] if valid else None, "list" if valid else "no price then"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [10, 10**9])
def test_prices_equal_a_search(spark, rows, hot):
    rng = random.Random(4)
    day = lambda: START + timedelta(hours=rng.randrange(200))
    product = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", "unknown", None])
    prices = [(rng.choice(["hot", "a", "b", "c", None]), rng.choice([None, day(), day()]), Decimal(rng.randrange(1, 50))) for _ in range(60)]
    prices += [("a", START, None), ("b", START, Decimal(3)), ("b", START, Decimal(2))]
    lines = [(product(), rng.choice([None, START, day(), day()]), rng.choice([None, None, Decimal(7)]), n, "x") for n in range(500)]
    lines += lines[:5]
    frame = spark.createDataFrame(lines, LINES).repartition(4)
    found = priced_as_of(frame, spark.createDataFrame(prices, PRICES), min_hot_rows=hot)
    assert rows(found) == brute(lines, prices)


def test_without_prices_or_lines(spark, rows):
    line = ("a", START, None, 1, None)
    none = spark.createDataFrame([], PRICES)
    assert rows(priced_as_of(spark.createDataFrame([line], LINES), none), "unit_price", "price_source") == [(None, "no price then")]
    assert priced_as_of(spark.createDataFrame([], LINES), none).count() == 0
