"""Named queries over the sample tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwright.functions.dates import month_bucket
from tillwright.operators import (
    dimensions,
    facts,
    headings,
    ingest,
    lookups,
    loyalty,
    orders,
    pages,
    prices,
    quality,
    regions,
    reshape,
    snapshots,
)
from tillwright.plans import reports, warehouse_load, weekly_ingest
from tillwright.plans.warehouse_load import Masters
from tillwright.session import free_shuffles, listing_by_few, prepare, shared_folder
from tillwright.sinks import keyvalue, lake, orders as saved, warehouse
from tillwright.sources import order_files, sample_tables as sample, snapshots as snapshots_in
from tillwright.sources.tables import Store, read_csv, read_stores
from tillwright.sources.views import name_tables
from tillwright.streaming import events as event_stream, sales as sales_stream, state

AS_OF = datetime(2001, 8, 1)
EARLIER = datetime(1998, 8, 1)
BY_ORDER = ("transaction_id",)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; money comes out as double so that any client can compare it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(prepare(spark), folder)
        decimals = [f.name for f in result.schema if isinstance(f.dataType, T.DecimalType)]
        return result.withColumns({c: F.col(c).cast("double") for c in decimals})

    QUERIES[build.__name__] = run
    return run


def _aged(spark, folder, as_of=AS_OF, with_store=True):
    return ingest.aged_transactions(sample.transactions(spark, folder, with_store), as_of)


def _wide(spark, folder):
    items = sample.transaction_items(spark, folder)
    return ingest.wide_orders(_aged(spark, folder), items, keys=BY_ORDER)


# --- ingest --------------------------------------------------------------------


@query
def aged_transactions(spark, folder):
    return _aged(spark, folder)


@query
def items_of_aged(spark, folder):
    aged = _aged(spark, folder, EARLIER, with_store=False)
    return ingest.items_of(sample.transaction_items(spark, folder), aged, BY_ORDER)


@query
def item_rank(spark, folder):
    return ingest.rank_items(sample.transaction_items(spark, folder), BY_ORDER)


@query
def orders_wide(spark, folder):
    return _wide(spark, folder)


@query
def orders_long(spark, folder):
    return reshape.long_orders(_wide(spark, folder))


@query
def dropped_transactions(spark, folder):
    return facts.dropped_of(_aged(spark, folder), sample.transaction_items(spark, folder), BY_ORDER)


@query
def store_union(spark, folder):
    stores = [Store("store-1", folder), Store("store-2", folder)]
    return read_stores(spark, stores, "orders.parquet")


@query
def lake_raw_orders(spark, folder):
    """The weekly ingest from stores to the raw zone, read back."""
    base = shared_folder(spark, "lake")
    placed = sample.transactions(spark, folder)
    items = sample.transaction_items(spark, folder)
    for name, rows in (("transactions", placed.drop("store_name")), ("transaction_item", items)):
        rows.write.parquet(f"{base}/pos/{name}")
    stores = [Store("store-1", f"{base}/pos"), Store("store-2", f"{base}/pos")]
    snapshot = weekly_ingest.run(spark, stores, f"{base}/lake", AS_OF)
    return snapshots_in.raw_orders(spark, f"{base}/lake", snapshot).drop("part")


@query
def staged_inputs(spark, folder):
    """What a snapshot of three stores has and lacks when only two have delivered."""
    base = shared_folder(spark, "lake")
    placed = sample.transactions(spark, folder).drop("store_name")
    placed.write.parquet(f"{base}/pos/transactions")
    sample.transaction_items(spark, folder).write.parquet(f"{base}/pos/transaction_item")
    stores = [Store("store-1", f"{base}/pos"), Store("store-2", f"{base}/pos")]
    snapshot = weekly_ingest.stage(spark, stores, f"{base}/lake", AS_OF)
    names = ["store-1", "store-2", "store-3"]
    gone = snapshots_in.missing_inputs(spark, f"{base}/lake", names, snapshot)
    held = spark.read.parquet(f"{base}/lake/manifest").select("store_name", "table", "rows")
    lost = gone.select("store_name", "table", F.lit(None).cast("long").alias("rows"))
    return held.withColumn("missing", F.lit(False)).unionByName(lost.withColumn("missing", F.lit(True)))


@query
def csv_products(spark, folder):
    """Products with commas and quotes in their names, through CSV that begins with a mark."""
    path = f"{shared_folder(spark, 'export')}/products"
    odd = F.concat(F.col("product_name"), F.lit(', "'), F.col("id"), F.lit('"'))
    given = sample.products(spark, folder).withColumn("product_name", odd)
    lake.write_csv(given.withColumnRenamed("id", "\ufeffid"), path)
    return read_csv(spark, path, given.schema)


@query
def region_files(spark, folder):
    """Pages counted per region slug, from CSV in one folder per slug."""
    path = f"{shared_folder(spark, 'export')}/regions"
    links = regions.region_links(_titles(spark, folder), "https://stores.example.com/")
    # Folders are counted and then written; pages are read and matched once for both.
    found = links.select("page_id", "slug")
    held = shared_folder(spark, "links")
    found.write.parquet(held)
    lake.write_csv(spark.read.schema(found.schema).parquet(held), path, "slug")
    with listing_by_few(spark):
        written = spark.read.schema("page_id long, slug string").csv(path, header=True)
    return written.groupBy("slug").agg(F.count(F.lit(1)).alias("pages"), F.min("page_id").alias("first_page"))


@query
def stamped_exports(spark, folder):
    """Transactions of two moments, each exported under its time, and an empty export."""
    base = shared_folder(spark, "export")
    targets = [
        lake.export_table(_aged(spark, folder, moment, with_store=False), f"{base}/transactions", moment)
        for moment in (EARLIER, AS_OF, datetime(1990, 1, 1))
    ]
    rows = spark.read.parquet(*[t for t in targets if t])
    stamp = F.regexp_extract("_metadata.file_path", r"transactions_(\d{8}_\d{6})\.parquet", 1)
    return rows.select(stamp.alias("export")).groupBy("export").agg(F.count(F.lit(1)).alias("rows"))


@query
def snapshot_latest(spark, folder):
    taken = [
        _aged(spark, folder, moment, with_store=False).withColumn("snapshot_date", F.lit(label))
        for moment, label in ((EARLIER, "1998_08_01"), (AS_OF, "2001_08_01"), (EARLIER, "1999_08_01"))
    ]
    every = taken[0].unionByName(taken[1]).unionByName(taken[2])
    return snapshots.latest_per_key(every, keys=BY_ORDER)


@query
def first_transactions(spark, folder):
    return lookups.first_rows(
        sample.transactions(spark, folder, with_store=False), 3, "transaction_id"
    )


@query
def adhoc_sql(spark, folder):
    name_tables(
        transactions=sample.transactions(spark, folder, with_store=False),
        transaction_item=sample.transaction_items(spark, folder),
    )
    return spark.sql(
        """SELECT t.transaction_id, payment_method, product_id, quantity
           FROM transactions t JOIN transaction_item i ON i.transaction_id = t.transaction_id
           WHERE created_at <= TIMESTAMP_NTZ '1998-08-01 00:00:00' - INTERVAL 7 DAY"""
    )


# --- warehouse -------------------------------------------------------------------


def _dim_store(spark, folder):
    return dimensions.dim_store(sample.stores(spark, folder))


def _dim_employee(spark, folder):
    return dimensions.dim_employee(sample.employees(spark, folder), _dim_store(spark, folder))


def _dim_product(spark, folder):
    return dimensions.dim_product(sample.products(spark, folder))


def _tiered(spark, folder):
    return loyalty.assign_tiers(sample.loyalty(spark, folder), sample.tiers(spark))


def _dim_customer(spark, folder):
    return dimensions.dim_customer(sample.customers(spark, folder), _tiered(spark, folder))


_DIMS = (_dim_store, _dim_employee, _dim_customer, _dim_product)


def _dims(spark, folder):
    return [d(spark, folder) for d in _DIMS]


def _held_dims(spark, folder, base):
    """The same from a warehouse, for loads that look keys up several times."""
    dims = []
    for build in _DIMS:
        name = build.__name__.removeprefix("_")
        warehouse.write_dimension(build(spark, folder), base, name)
        dims.append(spark.read.parquet(f"{base}/{name}"))
    return dims


@query
def dim_store(spark, folder):
    return _dim_store(spark, folder)


@query
def dim_employee(spark, folder):
    return _dim_employee(spark, folder)


@query
def dim_product(spark, folder):
    return _dim_product(spark, folder)


@query
def dim_customer(spark, folder):
    return _dim_customer(spark, folder)


@query
def dim_date(spark, folder):
    return dimensions.dim_date_for(sample.table(spark, folder, "orders"), "o_orderdate")


@query
def dim_product_growth(spark, folder):
    """Keys for the products that an earlier load did not have."""
    products = sample.products(spark, folder)
    early = dimensions.dim_product(products.where("price < 950"))
    return early.unionByName(dimensions.dim_product(products, existing=early))


@query
def employee_history(spark, folder):
    """A second extract in which the employees below zero got a raise."""
    staff = sample.employees(spark, folder)
    raised = staff.withColumn(
        "salary", F.when(F.col("salary") < 0, F.col("salary") + 100).otherwise(F.col("salary"))
    )
    stores = _dim_store(spark, folder)
    return dimensions.refresh_employees(dimensions.dim_employee(staff, stores), raised, stores)


def _loaded_twice(spark, folder) -> str:
    """A warehouse loaded from early masters, then from the masters as they are.

    Early on, products below 950 cost one less and the others are unknown, and customers have
    the tier of the points they had in 1998.
    """
    base = shared_folder(spark, "warehouse")
    products = sample.products(spark, folder)
    early = _aged(spark, folder, EARLIER, with_store=False)
    points = early.groupBy("customer_id").agg(F.sum("point_changed").cast("long").alias("point"))
    then = sample.loyalty(spark, folder).drop("point").join(points, "customer_id")
    now = Masters(
        sample.stores(spark, folder), sample.employees(spark, folder), products,
        sample.customers(spark, folder), _tiered(spark, folder),
    )
    before = now._replace(
        products=products.where("price < 950").withColumn("price", F.expr("CAST(price - 1 AS DECIMAL(18,2))")),
        loyalty=loyalty.assign_tiers(then, sample.tiers(spark)),
    )
    warehouse_load.load_dimensions(spark, base, before, early)
    warehouse_load.load_dimensions(spark, base, now, _aged(spark, folder, with_store=False))
    return base


@query
def dimension_refresh(spark, folder):
    """Products and customers after a second load with other prices and tiers."""
    base = _loaded_twice(spark, folder)
    held = lambda name: warehouse_load.dimension(spark, base, name)
    products = held("dim_product").select(
        F.lit("product").alias("dimension"), F.col("product_key").alias("member_key"),
        F.col("product_id").alias("member"), F.col("price").cast("double").alias("price"),
        F.lit(None).cast("string").alias("tier"),
    )
    customers = held("dim_customer").select(
        F.lit("customer").alias("dimension"), F.col("customer_key").alias("member_key"),
        F.col("customer_id").alias("member"), F.lit(None).cast("double").alias("price"), "tier",
    )
    return products.unionByName(customers)


@query
def calendar_loaded(spark, folder):
    """The calendar that two loads leave behind."""
    return warehouse_load.dimension(spark, _loaded_twice(spark, folder), "dim_date")


@query
def fact_sales(spark, folder):
    return facts.fact_of_items(
        _aged(spark, folder),
        sample.transaction_items(spark, folder),
        *_dims(spark, folder),
        keys=BY_ORDER,
    )


@query
def fact_sales_from_wide(spark, folder):
    return facts.fact_sales(_wide(spark, folder), *_dims(spark, folder))


@query
def fact_point_transaction(spark, folder):
    return facts.fact_point_transaction(
        _aged(spark, folder), _dim_store(spark, folder), _dim_customer(spark, folder)
    )


@query
def idempotent_append(spark, folder):
    """Item rows loaded from an early, a late and again the late snapshot."""
    path = shared_folder(spark, "facts")
    items = sample.transaction_items(spark, folder)
    for moment in (EARLIER, AS_OF, AS_OF):
        month = month_bucket(F.col("created_at")).alias("month")
        warehouse.append_facts(
            _aged(spark, folder, moment).join(items, [*BY_ORDER]).select("*", month),
            path,
            ("transaction_id", "product_id"),
            ("store_name", "created_at"),
            months=warehouse.months_of(
                _aged(spark, folder, moment, with_store=False).select(month)
            ),
        )
    return spark.read.parquet(path)


# --- orders ------------------------------------------------------------------------


@query
def price_lookup(spark, folder):
    returned = sample.table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    wanted = returned.select(F.col("l_partkey").cast("string").alias("id"))
    return lookups.prices_for(sample.products(spark, folder), wanted)


@query
def order_totals(spark, folder):
    return orders.item_totals(
        sample.order_headers(spark, folder), sample.order_lines(spark, folder)
    )


@query
def order_totals_percent(spark, folder):
    return orders.item_totals(
        sample.order_headers(spark, folder), sample.order_lines(spark, folder),
        discount_mode="percent",
    ).select("transaction_id", "total_amount", "final_amount")


def _normal(spark, folder):
    return orders.normalise_orders(sample.order_documents(spark, folder))


def _ntz(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query
def order_header_rows(spark, folder):
    return _ntz(_normal(spark, folder).headers, "created_at")


@query
def order_item_rows(spark, folder):
    return _normal(spark, folder).items


@query
def order_rejects(spark, folder):
    return _normal(spark, folder).rejected.select(
        "transaction_id", "customer_id", "given_payment", "reject_reason"
    )


@query
def saved_order_items(spark, folder):
    """Order items read back: a batch saved twice counts once, one without a marker never."""
    path = shared_folder(spark, "saved")
    # Five writes follow; the documents are built, parsed and judged once for all of them.
    judged = orders.judge_orders(orders.parse_orders(sample.order_documents(spark, folder))).drop("document")
    judged.write.parquet(f"{path}/judged")
    normal = orders.normal_form(spark.read.schema(judged.schema).parquet(f"{path}/judged"))
    for _ in range(2):
        saved.save_orders(normal.headers, normal.items, path, "1")
    normal.items.write.parquet(f"{path}/transaction_item/batch_id=2")
    headers, items = saved.saved_orders(spark, path)
    return items.join(headers.select("transaction_id", "customer_id"), "transaction_id").drop("batch_id")


def _uploads(spark, folder):
    """Order documents as rows of uploaded CSV, some of which cannot be read."""
    path = f"{shared_folder(spark, 'upload')}/orders"
    parsed = orders.parse_orders(sample.order_documents(spark, folder)).drop("document")
    number = F.col("transaction_id").cast("long")
    cells = parsed.select(
        "transaction_id", "customer_id", "employee_id",
        F.when(number % 31 == 0, "yesterday").otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
        F.when(number % 17 == 0, '{"product_id"').when(number % 19 == 0, '[{"quantity": "two"}]')
        .otherwise(F.to_json("items")).alias("items"),
        F.when(number % 23 == 0, "5 %").otherwise(F.concat(F.lit(" "), F.col("discount"))).alias("discount"),
        "payment_method",
    )
    lake.write_csv(cells, path)
    return order_files.split_uploads(order_files.read_uploads(spark, path))


@query
def upload_items(spark, folder):
    """Items of the valid orders among uploaded files."""
    return orders.normal_form(orders.judge_orders(_uploads(spark, folder)[0].withColumn("document", F.lit(None)))).items


@query
def upload_rejects(spark, folder):
    """Uploaded rows that cannot be read, by reason."""
    quarantined = _uploads(spark, folder)[1]
    return quarantined.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def lines_priced_as_of(spark, folder):
    """Items of which two thirds come without a price, priced by a list that changed once.

    Every tenth product has no price before the change.
    """
    products = sample.products(spark, folder)
    number = F.col("id").cast("int")
    changed = F.expr("date_add(DATE '1995-01-01', CAST(id AS INT) % 1000)").cast("timestamp_ntz")
    first = products.where(number % 10 > 0).select(
        F.col("id").alias("product_id"), F.lit(datetime(1992, 1, 1)).cast("timestamp_ntz").alias("valid_from"), "price"
    )
    second = products.select(
        F.col("id").alias("product_id"), changed.alias("valid_from"), (F.col("price") + 5).alias("price")
    )
    placed = sample.transactions(spark, folder, with_store=False).select("transaction_id", "created_at")
    lines = sample.transaction_items(spark, folder).join(placed, "transaction_id")
    own = F.when(F.col("transaction_id") % 3 == 0, F.lit(1).cast("decimal(18,2)"))
    return prices.priced_as_of(lines.withColumn("unit_price", own), first.unionByName(second))


@query
def product_by_key(spark, folder):
    """The product of the most order lines, looked up by its key."""
    lines = sample.transaction_items(spark, folder).groupBy("product_id").count()
    most = lines.orderBy(F.desc("count"), "product_id").first().product_id
    return lookups.price_list(lookups.row_by_key(sample.products(spark, folder), F.col("id") == most))


# --- quality -------------------------------------------------------------------------


@query
def quality_report(spark, folder):
    return quality.store_report(
        sample.employees(spark, folder),
        sample.products(spark, folder),
        sample.transactions(spark, folder, with_store=False),
        sample.transaction_items(spark, folder),
        BY_ORDER,
        sample.store_rows(spark, folder),
    )


def _spoilt(rows: DataFrame, number: str, repeat_every: int, **values: tuple[int, str]) -> DataFrame:
    """``rows`` with columns set to an expression in every so many numbers, and rows repeated."""
    spoilt = rows.withColumns(
        {c: F.when(F.expr(f"{number} % {n} = 0"), F.expr(e)).otherwise(F.col(c)) for c, (n, e) in values.items()}
    )
    return spoilt.unionByName(spoilt.where(F.expr(f"{number} % {repeat_every} = 0")))


@query
def quality_report_dirty(spark, folder):
    """The same report over store tables in which every constraint is broken."""
    return quality.store_report(
        _spoilt(
            sample.employees(spark, folder), "id", 11,
            employee_name=(9, "NULL"), start_date=(4, "NULL"), salary=(5, "NULL"),
        ),
        _spoilt(
            sample.products(spark, folder), "CAST(id AS LONG)", 19,
            price=(13, "-price"), product_name=(23, "IF(id % 2 = 0, NULL, 'same')"),
        ).withColumn("price", F.when(F.expr("CAST(id AS LONG) % 17 > 0"), F.col("price"))),
        _spoilt(
            sample.transactions(spark, folder, with_store=False), "transaction_id", 12,
            employee_id=(6, "IF(transaction_id % 4 = 0, NULL, 1000000)"), created_at=(9, "NULL"),
            final_amount=(10, "IF(transaction_id % 3 = 0, NULL, -final_amount)"),
            payment_method=(8, "'cheque'"),
        ),
        _spoilt(
            sample.transaction_items(spark, folder), "quantity", 7,
            product_id=(15, "concat('none-', product_id)"), transaction_id=(16, "-transaction_id"),
        ),
        BY_ORDER,
        sample.store_rows(spark, folder),
    )


@query
def loyalty_quality_report(spark, folder):
    return quality.loyalty_report(
        sample.tiers(spark), sample.customers(spark, folder), _tiered(spark, folder)
    )


@query
def masked_customers(spark, folder):
    return quality.masked_customers(sample.customers(spark, folder))


# --- loyalty ---------------------------------------------------------------------------


@query
def customer_profile(spark, folder):
    return loyalty.customer_profiles(sample.customers(spark, folder), _tiered(spark, folder))


@query
def unknown_customers(spark, folder):
    requests = sample.customer_requests(spark, folder).select("id")
    _, missing = loyalty.profiles_requested(
        requests, sample.customers(spark, folder), sample.loyalty(spark, folder)
    )
    return missing


@query
def customer_upsert(spark, folder):
    return loyalty.upsert_customers(
        sample.customers(spark, folder), sample.customer_requests(spark, folder)
    )


def _judged_requests(spark, folder):
    """Signups as requests, some without an id or a name."""
    given = sample.customer_requests(spark, folder)
    number = F.regexp_extract("name", r"(\d+)", 1).cast("long")
    return loyalty.judge_customer_requests(
        given.withColumns(
            {
                "id": F.when(number % 11 == 0, "").when(number % 13 == 0, None).otherwise(F.col("id")),
                "name": F.when(number % 7 > 0, F.col("name")),
            }
        )
    )


@query
def request_rejects(spark, folder):
    rejected = _judged_requests(spark, folder).rejected
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("requests"))


@query
def valid_upserts(spark, folder):
    """The customer table after the valid ones of requests."""
    valid = _judged_requests(spark, folder).valid
    return loyalty.upsert_customers(sample.customers(spark, folder), valid)


@query
def points_accrual(spark, folder):
    return loyalty.accrue_points(
        sample.loyalty(spark, folder), sample.accrual_requests(spark, folder)
    )


@query
def tier_assignment(spark, folder):
    return _tiered(spark, folder).select("customer_id", "point", "tier")


# --- events ------------------------------------------------------------------------------


@query
def point_events(spark, folder):
    return event_stream.point_events(sample.loyalty(spark, folder), "store-1")


@query
def event_rejects(spark, folder):
    rejected = event_stream.parse_events(sample.messages(spark, folder)).rejected
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


def _event_stream(spark, folder):
    """The sample messages, written out and read back as a stream."""
    base = shared_folder(spark, "events")
    messages = sample.messages(spark, folder)
    event_stream.write_topic(messages, "parquet", {"path": f"{base}/topic"})
    stream = event_stream.read_topic(
        spark, "parquet", {"path": f"{base}/topic", "maxFilesPerTrigger": "4"}, messages.schema
    )
    return base, event_stream.parse_events(stream).valid


def _settled(spark, base, running):
    state.keep_state(running, f"{base}/state", f"{base}/checkpoint").awaitTermination()
    return keyvalue.read_state(spark, f"{base}/state", ["customer_id"])


@query
def stream_points(spark, folder):
    base, stream = _event_stream(spark, folder)
    return _settled(spark, base, state.latest_points(stream))


@query
def stream_customers(spark, folder):
    base, stream = _event_stream(spark, folder)
    kept = _settled(spark, base, state.latest_customers(stream))
    return _ntz(kept, "join_date")


@query
def stream_upserts(spark, folder):
    """Customers that requests created or renamed, as events from the store, read centrally."""
    base = shared_folder(spark, "events")
    asked = loyalty.upsert_customers(sample.customers(spark, folder), _judged_requests(spark, folder).valid)
    changed = asked.where("created IS NOT NULL").withColumn("requested_at", F.lit(AS_OF))
    sent = event_stream.customer_events(changed, "store-1")
    event_stream.write_topic(sent, "parquet", {"path": f"{base}/topic"})
    stream = event_stream.read_topic(
        spark, "parquet", {"path": f"{base}/topic"}, T.StructType().add("value", "string")
    )
    kept = _settled(spark, base, state.latest_customers(event_stream.parse_events(stream).valid))
    return _ntz(kept, "join_date")


@query
def stream_accrual(spark, folder):
    """Every purchase is delivered twice and counted once."""
    base, stream = _event_stream(spark, folder)
    again = event_stream.read_topic(
        spark, "parquet", {"path": f"{base}/topic", "maxFilesPerTrigger": "4"},
        T.StructType().add("value", "string"),
    )
    delivered = stream.unionByName(event_stream.parse_events(again).valid)
    state.accrue_once(delivered, f"{base}/accrual", f"{base}/checkpoint").awaitTermination()
    return _ntz(state.accrued_totals(spark, f"{base}/accrual"), "last_updated")


@query
def stream_sales(spark, folder):
    """Order documents as a stream into order tables, rejects and the sales fact."""
    base = shared_folder(spark, "orders")
    documents = sample.order_documents(spark, folder)
    # Read once, as a stream: as text it would be several times as large as the tables.
    documents.write.option("compression", "gzip").text(f"{base}/topic")
    free_shuffles(spark)
    stream = event_stream.read_topic(
        spark, "text", {"path": f"{base}/topic", "maxFilesPerTrigger": "4"}
    )

    dims = _held_dims(spark, folder, base)

    def to_facts(valid: DataFrame) -> DataFrame:
        return facts.fact_of_orders(valid.withColumn("store_name", F.lit("store-1")), *dims)

    sales_stream.load_orders(
        stream, to_facts, f"{base}/facts", f"{base}/orders", f"{base}/rejects",
        f"{base}/checkpoint", made=facts.made_of_key(),
    ).awaitTermination()
    return _ntz(spark.read.parquet(f"{base}/facts"), "created_at")


# --- pages ---------------------------------------------------------------------------------

NAV_ENTRY = pages.Selector("li")
ARTICLE = pages.Selector("article")


@query
def page_links(spark, folder):
    return pages.harvest_links(sample.pages(spark, folder), NAV_ENTRY)


@query
def page_details(spark, folder):
    return pages.product_details(sample.pages(spark, folder), (ARTICLE,)).drop("url")


@query
def store_cards(spark, folder):
    return pages.store_cards(
        sample.pages(spark, folder),
        heading=pages.Selector("div", ("ad",)),
        card=pages.Selector("article"),
        name=pages.Selector("h1"),
        address=pages.Selector("p"),
    ).drop("url")


def _titles(spark, folder):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return sample.pages(spark, folder).select("page_id", title.alias("province"))


@query
def region_slug(spark, folder):
    return regions.region_links(_titles(spark, folder), "https://stores.example.com/")


@query
def heading_fill(spark, folder):
    """Each anchor text and the advert heading before it, over rows of page parts."""
    part = F.regexp_extract_all("html", F.lit(r'(?s)<a href="[^"]*">[^<]*|<div class="ad">[^<]*'), 0)
    parts = sample.pages(spark, folder).select("page_id", F.posexplode(part).alias("pos", "part"))
    heading = F.when(
        F.startswith("part", F.lit("<div")), F.regexp_replace("part", "^<[^>]*>", "")
    )
    return headings.fill_forward(
        parts.select("page_id", "pos", heading.alias("heading")), "heading", ["page_id"], "pos"
    )


# --- reports ---------------------------------------------------------------------------------


def _sales(spark, folder):
    """What reports use of the sales fact: item rows with the transaction's measures."""
    rows = _aged(spark, folder).join(sample.transaction_items(spark, folder), [*BY_ORDER])
    return rows.withColumn("month", month_bucket(F.col("created_at")))


@query
def sales_by_store_month(spark, folder):
    return reports.sales_by_store_month(_sales(spark, folder))


@query
def report_on_loaded_fact(spark, folder):
    """The monthly report over a sales fact that was loaded from overlapping batches, one of
    them with every row twice."""
    path = shared_folder(spark, "facts")
    dims = _held_dims(spark, folder, shared_folder(spark, "dimensions"))
    items = sample.transaction_items(spark, folder)
    for moment, repeats in ((EARLIER, 1), (AS_OF, 2), (AS_OF, 1)):
        fact = facts.fact_of_items(_aged(spark, folder, moment), items, *dims, keys=BY_ORDER)
        for _ in range(repeats - 1):
            fact = fact.unionByName(fact)
        month = month_bucket(F.col("created_at")).alias("month")
        warehouse.append_facts(
            fact, path,
            months=warehouse.months_of(_aged(spark, folder, moment, with_store=False).select(month)),
            made=facts.made_of_key(),
        )
    return reports.sales_by_store_month(spark.read.parquet(path))


@query
def top_products(spark, folder):
    return reports.top_products(_sales(spark, folder))


@query
def tier_summary(spark, folder):
    return reports.tier_summary(_tiered(spark, folder))
