"""The catalog's queries as ANSI SQL, to be checked on another engine."""

from __future__ import annotations

_AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
_EARLIER = "TIMESTAMP '1998-08-01 00:00:00'"
_SLOTS = range(1, 21)

# --- building blocks: the model tables as common table expressions ---------------

_TRANSACTIONS = """
tx AS (
  SELECT 'store-' || CAST(c.c_nationkey AS VARCHAR) AS store_name,
         o.o_orderkey AS transaction_id,
         CAST(o.o_orderkey % (SELECT count(*) FROM supplier) AS INTEGER) AS employee_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         o.o_orderdate AS created_at,
         CASE o.o_orderpriority
           WHEN '1-URGENT' THEN 'card' WHEN '2-HIGH' THEN 'card' WHEN '3-MEDIUM' THEN 'e-wallet'
           WHEN '4-NOT SPECIFIED' THEN 'cash' WHEN '5-LOW' THEN 'cash' END AS payment_method,
         CAST(0 AS DOUBLE) AS discount,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(floor(CAST(o.o_totalprice AS DECIMAL(18,2)) / 10000) AS BIGINT) AS point_changed
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

_TX_FIELDS = """employee_id, customer_id, created_at, payment_method, discount,
       CAST(amount AS DOUBLE) AS final_amount, point_changed"""

_AGED = f"aged AS (SELECT * FROM tx WHERE created_at <= {_AS_OF} - INTERVAL 7 DAY)"

_ITEMS = """
items AS (
  SELECT l_orderkey AS transaction_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""

_RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY product_id) AS r FROM items)"""

_SLOT_COLUMNS = ", ".join(
    f"max(CASE WHEN r = {i} THEN product_id END) AS product_id_{i}, "
    f"max(CASE WHEN r = {i} THEN quantity END) AS quantity_{i}"
    for i in _SLOTS
)
_SLOT_NAMES = ", ".join(f"product_id_{i}, quantity_{i}" for i in _SLOTS)
_WIDE = f"""
slots AS (SELECT transaction_id, {_SLOT_COLUMNS} FROM ranked GROUP BY transaction_id)"""

_LONG = """
long AS (SELECT aged.*, product_id, quantity FROM aged JOIN items USING (transaction_id))"""


def _numbered(natural: str) -> str:
    return f"row_number() OVER (ORDER BY md5(CAST({natural} AS VARCHAR)), {natural})"


_DIM_STORE = f"""
dim_store AS (
  SELECT {_numbered("id")} AS store_key, id AS store_id, id AS store_name,
         n_name AS address, r_name AS city, manager_id, DATE '1995-01-01' AS open_date,
         CAST(NULL AS DATE) AS close_date, CAST(1 AS SMALLINT) AS is_active
  FROM (SELECT 'store-' || CAST(n_nationkey AS VARCHAR) AS id, n_name, r_name,
               (SELECT CAST(min(s_suppkey) AS INTEGER) FROM supplier
                WHERE s_nationkey = n_nationkey) AS manager_id
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey))"""

_STAFF = """
staff AS (
  SELECT CAST(s_suppkey AS INTEGER) AS employee_id, s_name AS employee_name,
         'Cashier' AS position, DATE '1995-01-01' AS start_date,
         CAST(NULL AS DATE) AS retire_date,
         CAST(round(CAST(s_acctbal AS DECIMAL(18,2))) AS BIGINT) AS salary,
         COALESCE(store_key, 0) AS store_key
  FROM supplier LEFT JOIN dim_store ON store_id = 'store-' || CAST(s_nationkey AS VARCHAR))"""

_DIM_EMPLOYEE = f"""
dim_employee AS (
  SELECT {_numbered("employee_id")} AS employee_key, employee_id, employee_name, position,
         start_date, retire_date, salary, store_key, CAST(1 AS SMALLINT) AS is_current
  FROM staff)"""

_DIM_PRODUCT = f"""
dim_product AS (
  SELECT {_numbered("product_id")} AS product_key, product_id, product_name, price
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM part))"""

_CUSTOMERS = """
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, joined AS join_date
  FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS joined FROM orders
                           GROUP BY o_custkey) ON o_custkey = c_custkey)"""

_LOYALTY = """
loyal AS (
  SELECT customer_id, CAST(sum(point_changed) AS BIGINT) AS point,
         CAST(floor(sum(amount)) AS BIGINT) AS total_money_used,
         max(created_at) AS last_updated
  FROM tx GROUP BY customer_id),
tiered AS (
  SELECT *, CASE WHEN point >= 1000 THEN 'gold' WHEN point >= 500 THEN 'silver'
                 WHEN point >= 0 THEN 'bronze' END AS tier FROM loyal)"""

_DIM_CUSTOMER = f"""
dim_customer AS (
  SELECT {_numbered("id")} AS customer_key, id AS customer_id, name,
         CAST(join_date AS DATE) AS join_date, tier
  FROM customers LEFT JOIN tiered ON id = customer_id)"""

def _identity(*parts: str) -> str:
    written = (f"coalesce(length({p})::VARCHAR || ':' || {p}, '-')" for p in parts)
    return f"sha256({' || '.join(written)})"


_FACT = f"""
fact AS (
  SELECT {_identity("f.store_name", "CAST(transaction_id AS VARCHAR)", "f.product_id")}
           AS sales_key,
         CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
         COALESCE(s.store_key, 0) AS store_key, COALESCE(e.employee_key, 0) AS employee_key,
         COALESCE(c.customer_key, 0) AS customer_key, COALESCE(p.product_key, 0) AS product_key,
         quantity, discount, CAST(amount AS DOUBLE) AS final_amount, amount, point_changed,
         payment_method, created_at, f.store_name, transaction_id, f.product_id,
         CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month
  FROM long f
  LEFT JOIN dim_store s ON s.store_id = f.store_name
  LEFT JOIN dim_employee e ON e.employee_id = f.employee_id
  LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
  LEFT JOIN dim_product p ON p.product_id = f.product_id)"""

_WAREHOUSE = (
    _TRANSACTIONS, _AGED, _ITEMS, _LONG, _DIM_STORE, _STAFF, _DIM_EMPLOYEE, _DIM_PRODUCT,
    _CUSTOMERS, _LOYALTY, _DIM_CUSTOMER, _FACT,
)

_HEADERS = """
headers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(o_orderkey % 7 AS VARCHAR) AS employee_id, o_orderdate AS created_at,
         CAST(o_orderkey % 3 * 5 AS DECIMAL(18,2)) AS discount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'CREDIT_CARD' WHEN '2-HIGH' THEN 'card'
              WHEN '3-MEDIUM' THEN 'E_WALLET' WHEN '5-LOW' THEN 'voucher' END AS given
  FROM orders)"""

_LINES = """
lines AS (
  SELECT CAST(i.transaction_id AS VARCHAR) AS transaction_id, i.product_id, i.quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price
  FROM items i JOIN part ON p_partkey = CAST(i.product_id AS BIGINT))"""

_TOTALS = """
totals AS (
  SELECT h.*, COALESCE(t.total, 0) AS total, t.total IS NOT NULL AS filled,
         CAST(COALESCE(t.total, 0) - discount AS DECIMAL(18,2)) AS final
  FROM headers h LEFT JOIN (SELECT transaction_id, sum(quantity * unit_price) AS total
                            FROM lines GROUP BY transaction_id) t USING (transaction_id))"""

_VALID = """
valid AS (
  SELECT *, CASE given WHEN 'CREDIT_CARD' THEN 'card' WHEN 'card' THEN 'card'
                 WHEN 'E_WALLET' THEN 'e-wallet' ELSE 'cash' END AS payment_method
  FROM totals WHERE filled AND COALESCE(given, '') <> 'voucher')"""

_ORDERS = (_ITEMS, _HEADERS, _LINES, _TOTALS, _VALID)

_CUSTOMER_REQUESTS = """
requests AS (
  SELECT CAST(user_id + CASE WHEN user_id % 2 = 0 THEN 0
              ELSE (SELECT count(*) FROM customer) END AS VARCHAR) AS id,
         'User ' || CAST(event_id AS VARCHAR) AS name, ts
  FROM events WHERE event_type = 'signup')"""

_VALID_REQUESTS = """
requests AS (
  SELECT CAST(user_id + CASE WHEN user_id % 2 = 0 THEN 0
              ELSE (SELECT count(*) FROM customer) END AS VARCHAR) AS id,
         'User ' || CAST(event_id AS VARCHAR) AS name, ts
  FROM events
  WHERE event_type = 'signup' AND event_id % 11 > 0 AND event_id % 13 > 0 AND event_id % 7 > 0)"""
_ASKED = """
asked AS (SELECT id, arg_max(name, ts) AS asked_name, min(ts) AS first_ts FROM requests GROUP BY id)"""

_MILLIS = "CAST(epoch_us(ts) // 1000 AS BIGINT)"
_TITLE = "regexp_extract(html, '<title>(.*?)</title>', 1, 's')"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _text(html: str) -> str:
    """Text of a piece of HTML: tags and the blanks around them out, entities read."""
    text = rf"trim(regexp_replace({html}, '\s*<[^>]*>\s*', '', 'g'))"
    # A reference at the end of a cut-off text has lost its semicolon and still counts.
    for entity, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{sign}', 'g')"
    return text


def _slug(text: str) -> str:
    slug = f"strip_accents(replace(trim(lower({text})), 'đ', 'd'))"
    slug = f"regexp_replace({slug}, '[^\\x00-\\x7F]', '', 'g')"
    for short, full in (("tp.", "thanh pho"), ("tp ", "thanh pho "), ("t.", "tinh"), ("t ", "tinh ")):
        slug = f"replace({slug}, '{short}', '{full}')"
    slug = f"regexp_replace({slug}, '[^a-z0-9\\s-]', '', 'g')"
    slug = f"regexp_replace({slug}, '\\s+', '-', 'g')"
    return f"trim({slug}, '-')"


def _violation(check: str, table: str, broken: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", "
        f"CAST(count(*) FILTER (WHERE {broken}) AS BIGINT) AS violations FROM {source}"
    )


def _repeated(check: str, table: str, keys: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST(count(*) AS BIGINT) "
        f"AS violations FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


ORACLES: dict[str, str] = {
    "aged_transactions": f"""{_with(_TRANSACTIONS, _AGED)}
SELECT store_name, transaction_id, {_TX_FIELDS} FROM aged""",
    "items_of_aged": f"""{_with(_TRANSACTIONS, _ITEMS)}
SELECT * FROM items WHERE transaction_id IN
  (SELECT transaction_id FROM tx WHERE created_at <= {_EARLIER} - INTERVAL 7 DAY)""",
    "item_rank": f"""{_with(_ITEMS, _RANKED)}
SELECT transaction_id, product_id, quantity, CAST(r AS BIGINT) AS product_rank FROM ranked""",
    "orders_wide": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _RANKED, _WIDE)}
SELECT store_name, transaction_id, {_TX_FIELDS}, {_SLOT_NAMES}
FROM aged LEFT JOIN slots USING (transaction_id)""",
    "orders_long": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _LONG)}
SELECT store_name, transaction_id, {_TX_FIELDS}, product_id, quantity FROM long""",
    "dropped_transactions": f"""{_with(_TRANSACTIONS, _AGED)}
SELECT count(*) AS transactions,
       count(*) FILTER (WHERE transaction_id NOT IN (SELECT l_orderkey FROM lineitem))
         AS without_items FROM aged""",
    "store_union": """
SELECT *, 'store-1' AS store_name FROM orders
UNION ALL SELECT *, 'store-2' AS store_name FROM orders""",
    "lake_raw_orders": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _RANKED, _WIDE)}
SELECT transaction_id, {_TX_FIELDS}, {_SLOT_NAMES}, s.store_name, '2001_08_01' AS snapshot_date
FROM aged LEFT JOIN slots USING (transaction_id)
JOIN (VALUES ('store-1'), ('store-2')) s(store_name) ON TRUE""",
    "snapshot_latest": f"""{_with(_TRANSACTIONS, _AGED)}
SELECT transaction_id, {_TX_FIELDS}, '2001_08_01' AS snapshot_date FROM aged""",
    "first_transactions": f"""{_with(_TRANSACTIONS)}
SELECT transaction_id, {_TX_FIELDS} FROM tx ORDER BY transaction_id LIMIT 3""",
    "adhoc_sql": f"""{_with(_TRANSACTIONS, _ITEMS)}
SELECT transaction_id, payment_method, product_id, quantity
FROM tx JOIN items USING (transaction_id)
WHERE created_at <= {_EARLIER} - INTERVAL 7 DAY""",
    "dim_store": f"{_with(_DIM_STORE)} SELECT * FROM dim_store",
    "dim_employee": f"{_with(_DIM_STORE, _STAFF, _DIM_EMPLOYEE)} SELECT * FROM dim_employee",
    "dim_product": f"{_with(_DIM_PRODUCT)} SELECT * FROM dim_product",
    "dim_customer": f"""{_with(_TRANSACTIONS, _CUSTOMERS, _LOYALTY, _DIM_CUSTOMER)}
SELECT * FROM dim_customer""",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
       CAST(day(d) AS SMALLINT) AS day, CAST(month(d) AS SMALLINT) AS month,
       CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS INTEGER) AS year,
       CAST(week(d) AS SMALLINT) AS week, dayname(d) AS weekday_name,
       CAST(0 AS SMALLINT) AS is_holiday
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
      FROM orders)""",
    "dim_product_growth": f"""{_with(_DIM_PRODUCT)}
SELECT row_number() OVER (ORDER BY price >= 950, product_key) AS product_key,
       product_id, product_name, price FROM dim_product""",
    "dimension_refresh": f"""{_with(_TRANSACTIONS, _DIM_PRODUCT, _CUSTOMERS, _LOYALTY, _DIM_CUSTOMER)}
SELECT 'product' AS dimension, row_number() OVER (ORDER BY price >= 950, product_key) AS member_key,
       product_id AS member, price, CAST(NULL AS VARCHAR) AS tier FROM dim_product
UNION ALL
SELECT 'customer', customer_key, customer_id, NULL, tier FROM dim_customer""",
    "calendar_loaded": f"""{_with(_TRANSACTIONS, _AGED)}
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
       CAST(day(d) AS SMALLINT) AS day, CAST(month(d) AS SMALLINT) AS month,
       CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS INTEGER) AS year,
       CAST(week(d) AS SMALLINT) AS week, dayname(d) AS weekday_name,
       CAST(0 AS SMALLINT) AS is_holiday
FROM (SELECT unnest(generate_series(date_trunc('day', min(created_at)),
                                    date_trunc('day', max(created_at)), INTERVAL 1 DAY)) AS d
      FROM aged)""",
    "employee_history": f"""{_with(_DIM_STORE, _STAFF, _DIM_EMPLOYEE)}
SELECT employee_key, employee_id, employee_name, position, start_date, retire_date, salary,
       store_key, CAST(CASE WHEN salary < 0 THEN 0 ELSE 1 END AS SMALLINT) AS is_current
FROM dim_employee
UNION ALL
SELECT (SELECT max(employee_key) FROM dim_employee)
         + row_number() OVER (ORDER BY employee_key) AS employee_key,
       employee_id, employee_name, position, start_date, retire_date, salary + 100, store_key,
       CAST(1 AS SMALLINT)
FROM dim_employee WHERE salary < 0""",
    "fact_sales": f"{_with(*_WAREHOUSE)} SELECT * EXCLUDE (amount) FROM fact",
    "fact_sales_from_wide": f"{_with(*_WAREHOUSE)} SELECT * EXCLUDE (amount) FROM fact",
    "fact_point_transaction": f"""{_with(*_WAREHOUSE)}
SELECT {_identity("store_name", "CAST(transaction_id AS VARCHAR)")} AS transaction_key,
       COALESCE(customer_key, 0) AS customer_key, COALESCE(store_key, 0) AS store_key,
       CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
       point_changed AS points_changed, created_at AS transaction_time,
       CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month
FROM aged LEFT JOIN dim_store USING (store_name)
          LEFT JOIN dim_customer USING (customer_id)
WHERE point_changed <> 0""",
    "idempotent_append": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _LONG)}
SELECT store_name, transaction_id, {_TX_FIELDS}, product_id, quantity,
       CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month FROM long""",
    "price_lookup": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')""",
    "order_totals": f"""{_with(*_ORDERS)}
SELECT transaction_id, customer_id, employee_id, created_at, CAST(discount AS DOUBLE) AS discount,
       given AS payment_method, CAST(total AS DOUBLE) AS total_amount,
       CAST(final AS DOUBLE) AS final_amount, CAST(floor(final / 10000) AS BIGINT) AS point_changed
FROM totals""",
    "order_totals_percent": f"""{_with(*_ORDERS)}
SELECT transaction_id, CAST(total AS DOUBLE) AS total_amount,
       CAST(round(CAST(total AS DECIMAL(18,2)) * CAST(100 - discount AS DECIMAL(10,2))
            * CAST(0.01 AS DECIMAL(4,2)), 2) AS DOUBLE) AS final_amount
FROM totals""",
    "order_header_rows": f"""{_with(*_ORDERS)}
SELECT transaction_id, customer_id, employee_id, created_at, CAST(discount AS DOUBLE) AS discount,
       payment_method, CAST(total AS DOUBLE) AS total_amount,
       CAST(final AS DOUBLE) AS final_amount, CAST(floor(final / 10000) AS BIGINT) AS point_changed
FROM valid""",
    "order_item_rows": f"""{_with(*_ORDERS)}
SELECT transaction_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price
FROM lines WHERE transaction_id IN (SELECT transaction_id FROM valid)""",
    "order_rejects": f"""{_with(*_ORDERS)}
SELECT transaction_id, customer_id, COALESCE(given, 'CASH') AS given_payment,
       CASE WHEN NOT filled THEN 'no items' ELSE 'unknown payment method' END AS reject_reason
FROM totals WHERE NOT filled OR COALESCE(given, '') = 'voucher'""",
    "quality_report": _with(_TRANSACTIONS, _ITEMS)
    + " UNION ALL ".join(
        [
            _violation("employee_name not null", "employee", "s_name IS NULL", "supplier"),
            _violation("start_date not null", "employee", "FALSE", "supplier"),
            _violation("salary not null", "employee", "s_acctbal IS NULL", "supplier"),
            _violation("product_name not null", "products", "p_name IS NULL", "part"),
            _violation("price not null", "products", "p_retailprice IS NULL", "part"),
            _violation("price not negative", "products", "p_retailprice < 0", "part"),
            _violation("employee_id not null", "transactions", "employee_id IS NULL", "tx"),
            _violation("created_at not null", "transactions", "created_at IS NULL", "tx"),
            _violation("final_amount not null", "transactions", "amount IS NULL", "tx"),
            _violation("final_amount not negative", "transactions", "amount < 0", "tx"),
            _violation(
                "payment_method in domain", "transactions",
                "payment_method NOT IN ('cash', 'card', 'e-wallet')", "tx",
            ),
            _repeated("id unique", "employee", "s_suppkey", "supplier"),
            _repeated("id unique", "products", "p_partkey", "part"),
            _repeated("product_name unique", "products", "p_name", "part"),
            _repeated("key unique", "transactions", "transaction_id", "tx"),
            _repeated("key unique", "transaction_item", "transaction_id, product_id", "items"),
            _violation(
                "employee_id known", "transactions",
                "employee_id NOT IN (SELECT s_suppkey FROM supplier)", "tx",
            ),
            _violation(
                "product_id known", "transaction_item",
                "product_id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)", "items",
            ),
            _violation(
                "transaction known", "transaction_item",
                "transaction_id NOT IN (SELECT transaction_id FROM tx)", "items",
            ),
        ]
    ),
    "quality_report_dirty": _with(
        _TRANSACTIONS,
        _ITEMS,
        """
staff AS (
  SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 > 0 THEN s_name END AS employee_name,
         s_suppkey % 4 > 0 AS started, CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal END AS salary
  FROM supplier, range(CASE WHEN s_suppkey % 11 = 0 THEN 2 ELSE 1 END))""",
        """
goods AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 23 > 0 THEN p_name WHEN p_partkey % 2 = 1 THEN 'same' END
           AS product_name,
         CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN -p_retailprice
              ELSE p_retailprice END AS price
  FROM part, range(CASE WHEN p_partkey % 19 = 0 THEN 2 ELSE 1 END))""",
        """
orders_made AS (
  SELECT transaction_id,
         CASE WHEN transaction_id % 6 > 0 THEN employee_id WHEN transaction_id % 4 > 0 THEN 1000000 END
           AS employee_id,
         CASE WHEN transaction_id % 9 > 0 THEN created_at END AS created_at,
         CASE WHEN transaction_id % 10 > 0 THEN amount WHEN transaction_id % 3 > 0 THEN -amount END
           AS amount,
         CASE WHEN transaction_id % 8 = 0 THEN 'cheque' ELSE payment_method END AS payment_method
  FROM tx, range(CASE WHEN transaction_id % 12 = 0 THEN 2 ELSE 1 END))""",
        """
things AS (
  SELECT CASE WHEN quantity % 16 = 0 THEN -transaction_id ELSE transaction_id END AS transaction_id,
         CASE WHEN quantity % 15 = 0 THEN 'none-' || product_id ELSE product_id END AS product_id
  FROM items, range(CASE WHEN quantity % 7 = 0 THEN 2 ELSE 1 END))""",
    )
    + " UNION ALL ".join(
        [
            _violation("employee_name not null", "employee", "employee_name IS NULL", "staff"),
            _violation("start_date not null", "employee", "NOT started", "staff"),
            _violation("salary not null", "employee", "salary IS NULL", "staff"),
            _repeated("id unique", "employee", "id", "staff"),
            _violation("product_name not null", "products", "product_name IS NULL", "goods"),
            _violation("price not null", "products", "price IS NULL", "goods"),
            _violation("price not negative", "products", "price < 0", "goods"),
            _repeated("id unique", "products", "id", "goods"),
            _repeated(
                "product_name unique", "products", "product_name",
                "(SELECT product_name FROM goods WHERE product_name IS NOT NULL)",
            ),
            _violation("employee_id not null", "transactions", "employee_id IS NULL", "orders_made"),
            _violation("created_at not null", "transactions", "created_at IS NULL", "orders_made"),
            _violation("final_amount not null", "transactions", "amount IS NULL", "orders_made"),
            _violation("final_amount not negative", "transactions", "amount < 0", "orders_made"),
            _violation(
                "payment_method in domain", "transactions",
                "payment_method NOT IN ('cash', 'card', 'e-wallet')", "orders_made",
            ),
            _repeated("key unique", "transactions", "transaction_id", "orders_made"),
            _violation(
                "employee_id known", "transactions", "employee_id NOT IN (SELECT id FROM staff)",
                "orders_made",
            ),
            _repeated("key unique", "transaction_item", "transaction_id, product_id", "things"),
            _violation(
                "product_id known", "transaction_item",
                "product_id NOT IN (SELECT CAST(id AS VARCHAR) FROM goods)", "things",
            ),
            _violation(
                "transaction known", "transaction_item",
                "transaction_id NOT IN (SELECT transaction_id FROM orders_made)", "things",
            ),
        ]
    ),
    "loyalty_quality_report": _with(
        _TRANSACTIONS,
        _CUSTOMERS,
        _LOYALTY,
        "tiers AS (SELECT * FROM (VALUES ('bronze', 0, 0), ('silver', 500, 5), "
        "('gold', 1000, 10)) t(tier, min_point, discount_percentage))",
    )
    + " UNION ALL ".join(
        [
            _violation("min_point not null", "loyalty_tier", "min_point IS NULL", "tiers"),
            _violation("min_point not negative", "loyalty_tier", "min_point < 0", "tiers"),
            _violation(
                "discount_percentage not null", "loyalty_tier", "discount_percentage IS NULL",
                "tiers",
            ),
            _violation(
                "discount_percentage in range", "loyalty_tier",
                "discount_percentage NOT BETWEEN 0 AND 100", "tiers",
            ),
            _violation("name not null", "customer_info", "name IS NULL", "customers"),
            _violation("point not negative", "loyalty_customer", "point < 0", "tiered"),
            _violation(
                "total_money_used not negative", "loyalty_customer", "total_money_used < 0",
                "tiered",
            ),
            _repeated("tier unique", "loyalty_tier", "tier", "tiers"),
            _repeated("id unique", "customer_info", "id", "customers"),
            _repeated("customer_id unique", "loyalty_customer", "customer_id", "tiered"),
            _violation(
                "tier known", "loyalty_customer", "tier NOT IN (SELECT tier FROM tiers)", "tiered"
            ),
            _violation(
                "customer known", "loyalty_customer",
                "customer_id NOT IN (SELECT id FROM customers)", "tiered",
            ),
        ]
    ),
    "masked_customers": f"""{_with(_CUSTOMERS)}
SELECT sha256(id) AS id,
       regexp_replace(regexp_replace(regexp_replace(name, '[A-Z]', 'X', 'g'),
                                     '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS name,
       join_date FROM customers""",
    "customer_profile": f"""{_with(_TRANSACTIONS, _CUSTOMERS, _LOYALTY)}
SELECT id, name, join_date, point, total_money_used, last_updated, tier
FROM customers LEFT JOIN tiered ON id = customer_id""",
    "unknown_customers": f"""{_with(_CUSTOMERS, _CUSTOMER_REQUESTS)}
SELECT DISTINCT id FROM requests WHERE id NOT IN (SELECT id FROM customers)""",
    "customer_upsert": f"""{_with(_CUSTOMERS, _CUSTOMER_REQUESTS)},
asked AS (SELECT id, arg_max(name, ts) AS asked_name, min(ts) AS first_ts FROM requests GROUP BY id)
SELECT COALESCE(c.id, a.id) AS id, COALESCE(asked_name, name) AS name,
       CASE WHEN c.id IS NULL THEN first_ts ELSE join_date END AS join_date,
       CASE WHEN a.id IS NOT NULL THEN c.id IS NULL END AS created
FROM customers c FULL JOIN asked a ON c.id = a.id""",
    "points_accrual": f"""{_with(_TRANSACTIONS, _LOYALTY)},
earned AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, sum(CAST(floor(value) AS BIGINT)) AS points,
         sum(CAST(floor(value * 10000) AS BIGINT)) AS money, max(ts) AS latest
  FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT customer_id, CAST(NULL AS VARCHAR) AS tier,
       CAST(COALESCE(point, 0) + COALESCE(points, 0) AS BIGINT) AS point,
       CAST(COALESCE(total_money_used, 0) + COALESCE(money, 0) AS BIGINT) AS total_money_used,
       COALESCE(latest, last_updated) AS last_updated
FROM loyal FULL JOIN earned USING (customer_id)""",
    "tier_assignment": f"""{_with(_TRANSACTIONS, _LOYALTY)}
SELECT customer_id, point, tier FROM tiered""",
    "point_events": f"""{_with(_TRANSACTIONS, _LOYALTY)}
SELECT customer_id AS key,
       '{{"type":"loyalty.point_updated","timestamp":' || CAST(epoch_ms(last_updated) AS VARCHAR)
       || ',"payload":{{"customer_id":"' || customer_id || '","store_id":"store-1","points":'
       || CAST(point AS VARCHAR) || ',"total_money_used":' || CAST(total_money_used AS VARCHAR)
       || ',"last_updated":"' || strftime(last_updated, '%Y-%m-%dT%H:%M:%S.%f') || '"}}}}' AS value
FROM loyal""",
    "event_rejects": """
SELECT 'unknown type' AS reject_reason, count(*) AS messages
FROM events WHERE event_type NOT IN ('signup', 'purchase')""",
    "stream_points": f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       arg_max(CAST(floor(value) AS BIGINT), k) AS points,
       arg_max(CAST(floor(value * 10000) AS BIGINT), k) AS total_money_used
FROM (SELECT *, row_number() OVER (ORDER BY {_MILLIS}, floor(value), floor(value * 10000)) AS k
      FROM events WHERE event_type = 'purchase') GROUP BY user_id""",
    "stream_customers": f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       arg_max('User ' || CAST(event_id AS VARCHAR), k) AS name, arg_max(ts, k) AS join_date
FROM (SELECT *, row_number() OVER (ORDER BY {_MILLIS}, 'User ' || CAST(event_id AS VARCHAR)) AS k
      FROM events WHERE event_type = 'signup') GROUP BY user_id""",
    "stream_accrual": f"""
SELECT CAST(user_id AS VARCHAR) AS customer_id,
       CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS point,
       CAST(sum(CAST(floor(value * 10000) AS BIGINT)) AS BIGINT) AS total_money_used,
       make_timestamp(max({_MILLIS}) * 1000) AS last_updated
FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
    "stream_sales": f"""{_with(
        _TRANSACTIONS, _DIM_STORE, _STAFF, _DIM_EMPLOYEE, _DIM_PRODUCT, _CUSTOMERS, _LOYALTY,
        _DIM_CUSTOMER, *_ORDERS)}
SELECT {_identity("'store-1'", "transaction_id", "l.product_id")} AS sales_key,
       CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
       COALESCE(s.store_key, 0) AS store_key, COALESCE(e.employee_key, 0) AS employee_key,
       COALESCE(c.customer_key, 0) AS customer_key, COALESCE(p.product_key, 0) AS product_key,
       quantity, CAST(discount AS DOUBLE) AS discount, CAST(final AS DOUBLE) AS final_amount,
       CAST(floor(final / 10000) AS BIGINT) AS point_changed, payment_method, created_at,
       'store-1' AS store_name, transaction_id, l.product_id,
       CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month
FROM valid v JOIN lines l USING (transaction_id)
LEFT JOIN dim_store s ON s.store_id = 'store-1'
LEFT JOIN dim_employee e ON CAST(e.employee_id AS VARCHAR) = v.employee_id
LEFT JOIN dim_customer c ON c.customer_id = v.customer_id
LEFT JOIN dim_product p ON p.product_id = l.product_id""",
    "page_links": """
SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS link
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]+)"', 1) AS hrefs FROM pages)""",
    "page_details": f"""
SELECT page_id, {_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS name,
       '' AS price, '' AS code
FROM pages WHERE contains(html, '<article')""",
    # An unclosed paragraph runs to the end of its article.
    "store_cards": rf"""
WITH parts AS (
  SELECT page_id, regexp_extract(html, '<div class="ad">([^<]*)', 1) AS district,
         regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS shop_name,
         regexp_extract(html, '<article>.*?<p>.*?<p>(.*?)</article>', 1, 's') AS rest
  FROM pages WHERE contains(html, '<article')),
placed AS (
  SELECT *, CASE WHEN contains(split_part(rest, '</p>', 1), '<p>') THEN rest
                 ELSE split_part(rest, '</p>', 1) END AS address FROM parts)
SELECT page_id, CAST(0 AS INTEGER) AS pos, {_text("district")} AS district,
       {_text("shop_name")} AS shop_name,
       CASE WHEN rest <> '' THEN {_text("address")} END AS address
FROM placed""",
    "region_slug": f"""
SELECT page_id, province, slug, 'https://stores.example.com/' || slug AS link
FROM (SELECT page_id, {_TITLE} AS province, {_slug(_TITLE)} AS slug FROM pages)""",
    "heading_fill": r"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos,
       last_value(CASE WHEN part LIKE '<div%' THEN regexp_replace(part, '^<[^>]*>', '') END
                  IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading
FROM (SELECT page_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS part
      FROM (SELECT page_id, regexp_extract_all(
              html, '<a href="[^"]*">[^<]*|<div class="ad">[^<]*') AS parts FROM pages))""",
    "sales_by_store_month": f"""{_with(*_WAREHOUSE)}
SELECT store_name, CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month,
       count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS revenue,
       CAST(sum(point_changed) AS BIGINT) AS points
FROM aged WHERE transaction_id IN (SELECT transaction_id FROM fact)
GROUP BY 1, 2""",
    "top_products": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _LONG)}
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS order_lines
FROM long GROUP BY product_id ORDER BY quantity DESC, product_id LIMIT 10""",
    "tier_summary": f"""{_with(_TRANSACTIONS, _LOYALTY)}
SELECT tier, count(*) AS customers, CAST(sum(point) AS BIGINT) AS points,
       CAST(sum(total_money_used) AS BIGINT) AS total_money_used
FROM tiered GROUP BY tier""",
    "staged_inputs": f"""{_with(_TRANSACTIONS, _AGED, _ITEMS, _LONG)}
SELECT s AS store_name, t AS "table",
       CASE WHEN s = 'store-3' THEN NULL WHEN t = 'transactions' THEN (SELECT count(*) FROM aged)
            ELSE (SELECT count(*) FROM long) END AS rows, s = 'store-3' AS missing
FROM (VALUES ('store-1'), ('store-2'), ('store-3')) x(s),
     (VALUES ('transactions'), ('transaction_item')) y(t)""",
    "csv_products": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ', "' || CAST(p_partkey AS VARCHAR) || '"' AS product_name,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM part""",
    "region_files": f"""
SELECT CASE WHEN slug <> '' THEN slug END AS slug, count(*) AS pages, min(page_id) AS first_page
FROM (SELECT page_id, {_slug(_TITLE)} AS slug FROM pages) GROUP BY 1""",
    "stamped_exports": f"""{_with(_TRANSACTIONS)}
SELECT '19980801_000000' AS export, count(*) AS rows FROM tx
WHERE created_at <= {_EARLIER} - INTERVAL 7 DAY
UNION ALL SELECT '20010801_000000', count(*) FROM tx WHERE created_at <= {_AS_OF} - INTERVAL 7 DAY""",
    "saved_order_items": f"""{_with(*_ORDERS)}
SELECT transaction_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, customer_id
FROM lines JOIN valid USING (transaction_id)""",
    "upload_items": f"""{_with(*_ORDERS)}
SELECT transaction_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price
FROM lines WHERE transaction_id IN (
  SELECT transaction_id FROM valid
  WHERE CAST(transaction_id AS BIGINT) % 17 > 0 AND CAST(transaction_id AS BIGINT) % 19 > 0
    AND CAST(transaction_id AS BIGINT) % 31 > 0 AND CAST(transaction_id AS BIGINT) % 23 > 0)""",
    "upload_rejects": """
SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'unreadable items' WHEN o_orderkey % 19 = 0
              THEN 'items without numbers' WHEN o_orderkey % 31 = 0 THEN 'unreadable time'
            ELSE 'unreadable discount' END AS reject_reason, count(*) AS rows
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 31 = 0 OR o_orderkey % 23 = 0
GROUP BY 1""",
    "product_by_key": f"""{_with(_ITEMS)}
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM part WHERE CAST(p_partkey AS VARCHAR) = (
  SELECT product_id FROM items GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 1)""",
    "request_rejects": """
SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'missing id' ELSE 'missing name' END AS reject_reason,
       count(*) AS requests
FROM events WHERE event_type = 'signup' AND (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 7 = 0)
GROUP BY 1""",
    "valid_upserts": f"""{_with(_CUSTOMERS, _VALID_REQUESTS, _ASKED)}
SELECT COALESCE(c.id, a.id) AS id, COALESCE(asked_name, name) AS name,
       CASE WHEN c.id IS NULL THEN first_ts ELSE join_date END AS join_date,
       CASE WHEN a.id IS NOT NULL THEN c.id IS NULL END AS created
FROM customers c FULL JOIN asked a ON c.id = a.id""",
    "stream_upserts": f"""{_with(_CUSTOMERS, _VALID_REQUESTS, _ASKED)}
SELECT a.id AS customer_id, asked_name AS name,
       CASE WHEN c.id IS NULL THEN first_ts ELSE join_date END AS join_date
FROM asked a LEFT JOIN customers c ON c.id = a.id""",
    "report_on_loaded_fact": f"""{_with(*_WAREHOUSE)}
SELECT store_name, CAST(strftime(created_at, '%Y%m') AS INTEGER) AS month,
       count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS revenue,
       CAST(sum(point_changed) AS BIGINT) AS points
FROM aged WHERE transaction_id IN (SELECT transaction_id FROM fact)
GROUP BY 1, 2""",
    "lines_priced_as_of": f"""{_with(_TRANSACTIONS, _ITEMS)},
price AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, TIMESTAMP '1992-01-01' AS valid_from,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part WHERE p_partkey % 10 > 0
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(DATE '1995-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP),
         CAST(p_retailprice AS DECIMAL(18,2)) + 5 FROM part)
SELECT l.transaction_id, l.product_id, l.quantity, l.created_at,
       CAST(CASE WHEN l.transaction_id % 3 = 0 THEN 1 ELSE p.price END AS DOUBLE) AS unit_price,
       CASE WHEN l.transaction_id % 3 = 0 THEN 'own' WHEN p.price IS NULL THEN 'no price then' ELSE 'list' END
         AS price_source
FROM (SELECT transaction_id, product_id, quantity, created_at FROM items JOIN tx USING (transaction_id)) l
ASOF LEFT JOIN price p ON l.product_id = p.product_id AND l.created_at >= p.valid_from""",
}
