"""Constraint checks, and the report that gathers them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.identity import masked, pseudonym
from tillwright.functions.payments import storage_payment
from tillwright.session import partitions_for


def row_checks(rows: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of every rule about a single row, in one pass over the table.

    A rule is a column that is true where a row breaks it.
    """
    counts = rows.agg(
        *[
            F.coalesce(F.sum(broken.cast("int")), F.lit(0)).cast("long").alias(name)
            for name, broken in rules.items()
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in rules]
    )
    return counts.select(F.inline(pairs)).select(
        "check", F.lit(table).alias("table"), "violations"
    )


def missing(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low: float | None = None, high: float | None = None) -> Column:
    value = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (value < low)
    if high is not None:
        broken = broken | (value > high)
    return F.coalesce(broken, F.lit(False))


def outside_domain(column: str, domain: Sequence[str]) -> Column:
    value = F.col(column)
    return value.isNotNull() & ~F.lower(value).isin([d.lower() for d in domain])


def unknown_payment(column: str = "payment_method") -> Column:
    """A payment that no accepted spelling maps to the stored domain."""
    return F.col(column).isNotNull() & storage_payment(F.col(column)).isNull()


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with how many rows hold them."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unique_check(rows: DataFrame, table: str, name: str, keys: Sequence[str]) -> DataFrame:
    held = [F.col(k).isNotNull() for k in keys]
    present = rows.where(reduce(lambda a, b: a & b, held))
    return _one_row(duplicate_keys(present, keys).agg(F.count(F.lit(1))), table, name)


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values no parent has, with how many rows use them.

    Child rows are counted per value before a shuffled join, so a value that fills
    much of the table is one row by then. The planner joins first only where it can
    broadcast the parent.
    """
    used = child.where(F.col(foreign).isNotNull()).groupBy(F.col(foreign).alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = parent.select(F.col(key).alias("value"))
    return used.join(known, "value", "left_anti")


def foreign_check(
    child: DataFrame, table: str, name: str, foreign: str, parent: DataFrame, key: str
) -> DataFrame:
    lost = orphans(child, foreign, parent, key)
    return _one_row(lost.agg(F.coalesce(F.sum("rows"), F.lit(0))), table, name)


def _one_row(counted: DataFrame, table: str, name: str) -> DataFrame:
    return counted.select(
        F.lit(name).alias("check"),
        F.lit(table).alias("table"),
        F.col(counted.columns[0]).cast("long").alias("violations"),
    )


def report(*checks: DataFrame) -> DataFrame:
    """One row ``check, table, violations`` per check."""
    return reduce(DataFrame.unionByName, checks)


def violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, with the names of those they break."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return rows.withColumn("broken", broken).where(F.size("broken") > 0)


class Checked(NamedTuple):
    """A table with the rules of its rows, its unique keys (by name of the check) and its
    foreign keys: columns, and the table and unique key that they point to."""

    name: str
    rows: DataFrame
    rules: Mapping[str, Column] = {}
    unique: Mapping[str, Sequence[str]] = {}
    foreign: Mapping[str, tuple[Sequence[str], str, str]] = {}


RULES, PARENT = -1, -1


def _written(columns: Sequence[Column]) -> Column:
    """A key as text, null if a part of it is."""
    texts = [c.cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


# Rows of a rule or a foreign key are counted in so many parts first.
SALTS = 64


def constraint_report(tables: Sequence[Checked], rows: int | None = None) -> DataFrame:
    """``check, table, violations`` of every constraint of some tables, from one scan of each.

    A row tells the rules it breaks, the keys it holds and the keys it points to; one
    aggregate over all of them, which combines before its shuffle, knows for each key how
    many rows hold it and how many point to it. A unique check counts keys held more than once,
    a foreign check the rows that point to a key nobody holds. Keys with a null are neither
    held nor pointed to. Foreign keys are compared in the type of what they point to.

    ``rows`` is how many rows the tables have, about; they are counted if it is not given. Keys
    of many rows go to as many tasks as keep the keys of a task few. They are not combined
    before that, which fills memory with keys that never repeat; a rule or a foreign key of
    very many rows is counted in parts instead.
    """
    spaces = {(t.name, check): i for i, t in enumerate(tables) for check in t.unique}
    spaces = {space: i for i, space in enumerate(spaces)}
    pointing = {(t.name, check): i for i, t in enumerate(tables) for check in t.foreign}
    pointing = {child: i for i, child in enumerate(pointing)}
    keys = {(t.name, check): [t.rows.schema[c].dataType for c in t.unique[check]] for t in tables for check in t.unique}

    def event(space: int, key: Column, side: int) -> Column:
        told = F.struct(F.lit(space).alias("space"), key.alias("key"), F.lit(side).alias("side"))
        return F.when(key.isNotNull(), told)

    frames = []
    for table in tables:
        events = [event(RULES, F.when(broken, F.lit(f"{table.name}: {name}")), PARENT) for name, broken in table.rules.items()]
        for name, columns in table.unique.items():
            events.append(event(spaces[table.name, name], _written([F.col(c) for c in columns]), PARENT))
        for name, (columns, parent, held) in table.foreign.items():
            cast = [
                F.coalesce(F.col(c).try_cast(kind).cast("string"), F.col(c).cast("string"))
                for c, kind in zip(columns, keys[parent, held], strict=True)
            ]
            events.append(event(spaces[parent, held], _written(cast), pointing[table.name, name]))
        if events:
            frames.append(table.rows.select(F.inline(F.array_compact(F.array(*events)))))
    sides = [F.count_if(F.col("side") == i).alias(f"points_{i}") for i in pointing.values()]
    told = reduce(DataFrame.unionByName, frames)
    holds = F.count_if(F.col("side") == PARENT).alias("holds")
    if rows is None:
        rows = sum(t.rows.count() for t in tables)
    parts = partitions_for(told.sparkSession, rows)
    if parts:
        # Only a key that is held stays whole; all others may have any number of rows.
        many = (F.col("space") == RULES) | (F.col("side") != PARENT)
        told = told.withColumn("part", F.when(many, (F.rand(SALTS) * SALTS).cast("int")).otherwise(F.lit(0)))
        some = told.repartition(parts, "space", "key", "part").groupBy("space", "key", "part").agg(holds, *sides)
        sums = [F.sum(c).alias(c) for c in some.columns[3:]]
        counted = some.repartition(parts, "space", "key").groupBy("space", "key").agg(*sums)
    else:
        counted = told.groupBy("space", "key").agg(holds, *sides)
    found = []
    for table in tables:
        for name in table.rules:
            broken = (F.col("space") == RULES) & (F.col("key") == f"{table.name}: {name}")
            found.append((table.name, name, F.sum(F.when(broken, F.col("holds")))))
        for name in table.unique:
            repeated = (F.col("space") == spaces[table.name, name]) & (F.col("holds") > 1)
            found.append((table.name, name, F.count_if(repeated)))
        for name, (_, parent, held) in table.foreign.items():
            lost = (F.col("space") == spaces[parent, held]) & (F.col("holds") == 0)
            found.append((table.name, name, F.sum(F.when(lost, F.col(f"points_{pointing[table.name, name]}")))))
    sums = counted.agg(*[F.coalesce(total, F.lit(0)).cast("long").alias(f"_{i}") for i, (*_, total) in enumerate(found)])
    lines = [
        F.struct(F.lit(name).alias("check"), F.lit(table).alias("table"), F.col(f"_{i}").alias("violations"))
        for i, (table, name, _) in enumerate(found)
    ]
    return sums.select(F.inline(F.array(*lines)))


def store_report(
    employees: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    items: DataFrame,
    keys: Sequence[str] = ("store_name", "transaction_id"),
    rows: int | None = None,
) -> DataFrame:
    """Every constraint of the store tables, counted; ``rows`` as in ``constraint_report``."""
    return constraint_report(
        [
            Checked(
                "employee",
                employees,
                {
                    "employee_name not null": missing("employee_name"),
                    "start_date not null": missing("start_date"),
                    "salary not null": missing("salary"),
                },
                {"id unique": ["id"]},
            ),
            Checked(
                "products",
                products,
                {
                    "product_name not null": missing("product_name"),
                    "price not null": missing("price"),
                    "price not negative": outside("price", low=0),
                },
                {"id unique": ["id"], "product_name unique": ["product_name"]},
            ),
            Checked(
                "transactions",
                transactions,
                {
                    "employee_id not null": missing("employee_id"),
                    "created_at not null": missing("created_at"),
                    "final_amount not null": missing("final_amount"),
                    "final_amount not negative": outside("final_amount", low=0),
                    "payment_method in domain": unknown_payment(),
                },
                {"key unique": keys},
                {"employee_id known": (["employee_id"], "employee", "id unique")},
            ),
            Checked(
                "transaction_item",
                items,
                {},
                {"key unique": [*keys, "product_id"]},
                {
                    "product_id known": (["product_id"], "products", "id unique"),
                    "transaction known": (keys, "transactions", "key unique"),
                },
            ),
        ],
        rows,
    )


def loyalty_report(tiers: DataFrame, customers: DataFrame, loyalty: DataFrame) -> DataFrame:
    """Every constraint of the loyalty tables, counted."""
    return constraint_report(
        [
            Checked(
                "loyalty_tier",
                tiers,
                {
                    "min_point not null": missing("min_point"),
                    "min_point not negative": outside("min_point", low=0),
                    "discount_percentage not null": missing("discount_percentage"),
                    "discount_percentage in range": outside("discount_percentage", 0, 100),
                },
                {"tier unique": ["tier"]},
            ),
            Checked("customer_info", customers, {"name not null": missing("name")}, {"id unique": ["id"]}),
            Checked(
                "loyalty_customer",
                loyalty,
                {
                    "point not negative": outside("point", low=0),
                    "total_money_used not negative": outside("total_money_used", low=0),
                },
                {"customer_id unique": ["customer_id"]},
                {
                    "tier known": (["tier"], "loyalty_tier", "tier unique"),
                    "customer known": (["customer_id"], "customer_info", "id unique"),
                },
            ),
        ]
    )


def masked_customers(customers: DataFrame, secret: str = "") -> DataFrame:
    """Customers for analytics: no readable id, no readable name."""
    return customers.withColumns(
        {"id": pseudonym(F.col("id"), secret), "name": masked(F.col("name"))}
    )
