"""The retail model over order, line item, customer, part and event tables.

Adapters for tables that were made for something else: each function gives one
model table with the column names and types the operators expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwright.functions.dates import iso_text
from tillwright.operators.ingest import gather_items
from tillwright.operators.orders import priced_items
from tillwright.schemas import CUSTOMER_CREATED, POINT_UPDATED
from tillwright.session import partitions_for
from tillwright.streaming.events import envelope

PAYMENT_BY_PRIORITY = {
    "1-URGENT": "card",
    "2-HIGH": "card",
    "3-MEDIUM": "e-wallet",
    "4-NOT SPECIFIED": "cash",
    "5-LOW": "cash",
}


# Declared, so that reading a table runs no job to learn its columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _store_of(nation):
    return F.concat(F.lit("store-"), nation.cast("string"))


def transactions(spark: SparkSession, folder: str, with_store: bool = True) -> DataFrame:
    """Orders as transactions. The store is the customer's nation.

    ``with_store=False`` leaves the store, and with it the customer join, out.
    """
    orders = table(spark, folder, "orders")
    staff = table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    payment = F.lit(None).cast("string")
    for priority, method in PAYMENT_BY_PRIORITY.items():
        payment = F.when(F.col("o_orderpriority") == priority, method).otherwise(payment)
    columns = [
        F.col("o_orderkey").alias("transaction_id"),
        (F.col("o_orderkey") % staff).cast("int").alias("employee_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        payment.alias("payment_method"),
        F.lit(0).cast("decimal(5,2)").alias("discount"),
        amount.alias("final_amount"),
        F.floor(amount / 10000).cast("long").alias("point_changed"),
    ]
    if with_store:
        customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        orders = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
        columns = [_store_of(F.col("c_nationkey")).alias("store_name"), *columns]
    return orders.select(*columns)


def transaction_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items summed to one row per order and part.

    Few rows share both, so combining before the shuffle would only fill memory: many rows go
    by order to tasks of a bounded number of them, which a join by order can use as they lie.
    """
    lines = table(spark, folder, "lineitem")
    parts = partitions_for(spark, lines.count())
    if parts:
        lines = lines.select("l_orderkey", "l_partkey", "l_quantity").repartition(parts, "l_orderkey")
    summed = lines.groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").alias("_quantity")
    )
    return summed.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("_quantity").cast("long").alias("quantity"),
    )


def store_rows(spark: SparkSession, folder: str) -> int:
    """Rows of the tables of a store together, from what the files tell about themselves."""
    return sum(table(spark, folder, name).count() for name in ("supplier", "part", "orders", "lineitem"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.col("s_name").alias("employee_name"),
        F.lit("Cashier").alias("position"),
        F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("retire_date"),
        F.round(F.col("s_acctbal").cast("decimal(18,2)")).cast("long").alias("salary"),
        _store_of(F.col("s_nationkey")).alias("store_id"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as stores; the manager is the supplier with the smallest id there."""
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    managers = (
        table(spark, folder, "supplier")
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.min("s_suppkey").cast("int").alias("manager_id"))
    )
    placed = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"], "left")
    return placed.join(managers, "n_nationkey", "left").select(
        _store_of(F.col("n_nationkey")).alias("id"),
        F.col("n_name").alias("address"),
        F.col("r_name").alias("city"),
        "manager_id",
        F.lit("1995-01-01").cast("date").alias("open_date"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; they joined with their first order."""
    joined = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("join_date"))
    )
    return table(spark, folder, "customer").join(joined, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), "join_date"
    )


def tiers(spark: SparkSession) -> DataFrame:
    """The tier thresholds used with these tables."""
    return spark.sql(
        "SELECT * FROM VALUES ('bronze', 0, 0), ('silver', 500, 5), ('gold', 1000, 10)"
        " AS t(tier, min_point, discount_percentage)"
    )


def loyalty(spark: SparkSession, folder: str) -> DataFrame:
    """Points and money of every customer with an order; no tier yet."""
    return (
        transactions(spark, folder, with_store=False)
        .groupBy("customer_id")
        .agg(
            F.sum("point_changed").cast("long").alias("point"),
            F.floor(F.sum("final_amount")).cast("long").alias("total_money_used"),
            F.max("created_at").alias("last_updated"),
        )
        .select(
            "customer_id", F.lit(None).cast("string").alias("tier"), "point",
            "total_money_used", "last_updated",
        )
    )


def accrual_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as points accruals."""
    return table(spark, folder, "events").where("event_type = 'purchase'").select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.floor("value").cast("long").alias("earned_point"),
        F.floor(F.col("value") * 10000).cast("long").alias("amount"),
        F.col("ts").alias("requested_at"),
    )


def customer_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Signup events as create-or-update requests; ids above the customers are new."""
    known = table(spark, folder, "customer").agg(F.count(F.lit(1))).scalar()
    return table(spark, folder, "events").where("event_type = 'signup'").select(
        (F.col("user_id") + F.when(F.col("user_id") % 2 == 0, 0).otherwise(known))
        .cast("string")
        .alias("id"),
        F.concat(F.lit("User "), F.col("event_id").cast("string")).alias("name"),
        F.lit(None).cast("timestamp_ntz").alias("join_date"),
        F.col("ts").alias("requested_at"),
    )


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as they are placed: payment in the callers' spellings, some unknown."""
    spelled = {
        "1-URGENT": "CREDIT_CARD", "2-HIGH": "card", "3-MEDIUM": "E_WALLET", "5-LOW": "voucher",
    }
    payment = F.lit(None).cast("string")
    for priority, method in spelled.items():
        payment = F.when(F.col("o_orderpriority") == priority, method).otherwise(payment)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_orderkey") % 7).cast("string").alias("employee_id"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderkey") % 3 * 5).cast("decimal(18,2)").alias("discount"),
        payment.alias("payment_method"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Items at list price, with text ids as in order documents."""
    priced = priced_items(transaction_items(spark, folder), products(spark, folder))
    return priced.withColumn("transaction_id", F.col("transaction_id").cast("string"))


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON document per order in column ``value``."""
    items = gather_items(
        order_lines(spark, folder), ("transaction_id",),
        ("product_id", "quantity", "unit_price"),
    )
    orders = order_headers(spark, folder).join(items, "transaction_id", "left")
    return orders.select(F.to_json(F.struct(*orders.columns)).alias("value"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a message: signups name customers, purchases carry totals."""
    kind = (
        F.when(F.col("event_type") == "signup", CUSTOMER_CREATED)
        .when(F.col("event_type") == "purchase", POINT_UPDATED)
        .otherwise(F.col("event_type"))
    )
    signup, purchase = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    payload = F.struct(
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("store-1").alias("store_id"),
        F.when(signup, F.concat(F.lit("User "), F.col("event_id").cast("string"))).alias("name"),
        F.when(signup, iso_text(F.col("ts"))).alias("join_date"),
        F.when(purchase, F.floor("value").cast("long")).alias("points"),
        F.when(purchase, F.floor(F.col("value") * 10000).cast("long")).alias("total_money_used"),
        F.when(purchase, iso_text(F.col("ts"))).alias("last_updated"),
    )
    return table(spark, folder, "events").select(
        envelope(kind, F.col("ts"), payload).alias("value")
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url", "html")
