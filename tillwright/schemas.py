"""Declared schemas of the retail model, and its value domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STR, INT, LONG, SHORT = T.StringType(), T.IntegerType(), T.LongType(), T.ShortType()
DATE, TS = T.DateType(), T.TimestampType()
PERCENT = T.DecimalType(5, 2)
MONEY = T.DecimalType(18, 2)
# Sums of money, points and quantities are wide enough for a key that fills much of a
# table.
MONEY_SUM = T.DecimalType(28, 2)

# --- store systems -----------------------------------------------------------
EMPLOYEE = _struct(
    ("id", INT), ("employee_name", STR), ("position", STR),
    ("start_date", DATE), ("retire_date", DATE), ("salary", LONG),
)
STORE = _struct(
    ("id", STR), ("address", STR), ("city", STR), ("manager_id", INT), ("open_date", DATE),
)
PRODUCTS = _struct(("id", STR), ("product_name", STR), ("price", LONG))
TRANSACTIONS = _struct(
    ("transaction_id", INT), ("employee_id", INT), ("customer_id", STR), ("created_at", TS),
    ("payment_method", STR), ("discount", PERCENT), ("final_amount", LONG), ("point_changed", INT),
)
TRANSACTION_ITEM = _struct(("transaction_id", INT), ("product_id", STR), ("quantity", INT))

# --- loyalty -----------------------------------------------------------------
LOYALTY_TIER = _struct(
    ("tier", STR), ("min_point", INT), ("discount_percentage", PERCENT), ("description", STR),
)
CUSTOMER_INFO = _struct(("id", STR), ("name", STR), ("join_date", TS))
LOYALTY_CUSTOMER = _struct(
    ("customer_id", STR), ("tier", STR), ("point", LONG), ("total_money_used", LONG),
    ("last_updated", TS),
)
CUSTOMERS_POINT = _struct(
    ("customer_id", STR), ("tier", STR), ("points", LONG), ("total_money_used", LONG),
)
CUSTOMERS_INFO = _struct(("customer_id", STR), ("name", STR), ("join_date", TS))
ACCRUAL = _struct(("customer_id", STR), ("earned_point", LONG), ("amount", LONG))

# --- warehouse ---------------------------------------------------------------
DIM_STORE = _struct(
    ("store_key", LONG), ("store_id", STR), ("store_name", STR), ("address", STR), ("city", STR),
    ("manager_id", INT), ("open_date", DATE), ("close_date", DATE), ("is_active", SHORT),
)
DIM_EMPLOYEE = _struct(
    ("employee_key", LONG), ("employee_id", INT), ("employee_name", STR), ("position", STR),
    ("start_date", DATE), ("retire_date", DATE), ("salary", LONG), ("store_key", LONG),
    ("is_current", SHORT),
)
DIM_PRODUCT = _struct(
    ("product_key", LONG), ("product_id", STR), ("product_name", STR), ("price", LONG),
)
DIM_CUSTOMER = _struct(
    ("customer_key", LONG), ("customer_id", STR), ("name", STR), ("join_date", DATE), ("tier", STR),
)
DIM_DATE = _struct(
    ("date_key", INT), ("full_date", DATE), ("day", SHORT), ("month", SHORT), ("quarter", SHORT),
    ("year", INT), ("week", SHORT), ("weekday_name", STR), ("is_holiday", SHORT),
)

# --- order documents and events ------------------------------------------------
ORDER_ITEM = _struct(("product_id", STR), ("quantity", LONG), ("unit_price", MONEY))
ORDER = _struct(
    ("transaction_id", STR), ("customer_id", STR), ("employee_id", STR), ("created_at", TS),
    ("items", T.ArrayType(ORDER_ITEM)), ("discount", MONEY), ("payment_method", STR),
)
EVENT_PAYLOAD = _struct(
    ("customer_id", STR), ("store_id", STR), ("name", STR), ("join_date", STR),
    ("points", LONG), ("total_money_used", LONG), ("last_updated", STR),
)
EVENT = _struct(("type", STR), ("timestamp", LONG), ("payload", EVENT_PAYLOAD))

PAGES = _struct(("page_id", LONG), ("url", STR), ("html", STR))

# The stored payment domain and the names callers may send for it.
PAYMENT_DOMAIN = ("cash", "card", "e-wallet")
PAYMENT_ALIASES = {
    "cash": "cash",
    "card": "card",
    "credit_card": "card",
    "e-wallet": "e-wallet",
    "e_wallet": "e-wallet",
}
DEFAULT_PAYMENT = "CASH"

# Event types on the loyalty topic.
CUSTOMER_CREATED = "customer.created"
CUSTOMER_UPDATED = "customer.updated"
POINT_UPDATED = "loyalty.point_updated"
EVENT_TYPES = (CUSTOMER_CREATED, CUSTOMER_UPDATED, POINT_UPDATED)
