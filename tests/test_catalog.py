"""Every query of the catalog against its SQL on the smallest sample tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tillwright.plans.catalog import QUERIES
from tillwright.plans.catalog_sql import ORACLES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'"
        ).fetchall()
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    described = {r[0] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert described == set(columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(map(repr, want))
