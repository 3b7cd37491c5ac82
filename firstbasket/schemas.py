"""Declared schemas of the ten source roles (fixed, never inferred).

Column order matters: CSV ingest binds columns by position, as a
database COPY does, so these constants double as the positional layout.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(12, 2)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


CATEGORY_TRANSLATION = _s(
    ("product_category_name", StringType(), False),
    ("product_category_name_english", StringType(), True),
)

PRODUCTS = _s(
    ("product_id", StringType(), False),
    ("product_category_name", StringType(), True),
    ("product_name_length", IntegerType(), True),
    ("product_description_length", IntegerType(), True),
    ("product_photos_qty", IntegerType(), True),
    ("product_weight_g", IntegerType(), True),
    ("product_length_cm", IntegerType(), True),
    ("product_height_cm", IntegerType(), True),
    ("product_width_cm", IntegerType(), True),
)

CUSTOMERS = _s(
    ("customer_id", StringType(), False),
    ("customer_unique_id", StringType(), False),
    ("customer_zip_code_prefix", StringType(), True),
    ("customer_city", StringType(), True),
    ("customer_state", StringType(), True),
)

ORDERS = _s(
    ("order_id", StringType(), False),
    ("customer_id", StringType(), False),
    ("order_status", StringType(), False),
    ("order_purchase_timestamp", TimestampNTZType(), True),
    ("order_approved_at", TimestampNTZType(), True),
    ("order_delivered_carrier_date", TimestampNTZType(), True),
    ("order_delivered_customer_date", TimestampNTZType(), True),
    ("order_estimated_delivery_date", TimestampNTZType(), True),
)

SELLERS = _s(
    ("seller_id", StringType(), False),
    ("seller_zip_code_prefix", StringType(), True),
    ("seller_city", StringType(), True),
    ("seller_state", StringType(), True),
)

ORDER_ITEMS = _s(
    ("order_id", StringType(), False),
    ("order_item_id", IntegerType(), False),
    ("product_id", StringType(), False),
    ("seller_id", StringType(), False),
    ("shipping_limit_date", TimestampNTZType(), True),
    ("price", MONEY, False),
    ("freight_value", MONEY, True),
)

ORDER_PAYMENTS = _s(
    ("order_id", StringType(), False),
    ("payment_sequential", IntegerType(), False),
    ("payment_type", StringType(), True),
    ("payment_installments", IntegerType(), True),
    ("payment_value", MONEY, True),
)

ORDER_REVIEWS = _s(
    ("order_id", StringType(), False),
    ("review_id", StringType(), False),
    ("review_score", IntegerType(), True),
    ("review_comment_title", StringType(), True),
    ("review_comment_message", StringType(), True),
    ("review_creation_date", TimestampNTZType(), True),
    ("review_answer_timestamp", TimestampNTZType(), True),
)

# The raw review export carries the same columns with review_id first.
ORDER_REVIEWS_RAW = StructType([ORDER_REVIEWS["review_id"], ORDER_REVIEWS["order_id"]]
                               + [f for f in ORDER_REVIEWS.fields if f.name not in ("review_id", "order_id")])

GEOLOCATION = _s(
    ("geolocation_zip_code_prefix", StringType(), True),
    ("geolocation_lat", DoubleType(), True),
    ("geolocation_lng", DoubleType(), True),
    ("geolocation_city", StringType(), True),
    ("geolocation_state", StringType(), True),
)
GEOLOCATION_KEY = "geolocation_sk"

STATE_MEDIAN_INCOME = _s(
    ("state_code", StringType(), False),
    ("median_monthly_income_2017", MONEY, True),
)

# Primary keys (uniqueness checks) and the not-null columns of each role.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "category_translation": ("product_category_name",),
    "products": ("product_id",),
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "sellers": ("seller_id",),
    "order_items": ("order_id", "order_item_id"),
    "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("order_id",),
    "geolocation": (GEOLOCATION_KEY,),
    "state_median_income": ("state_code",),
}

# (child role, child columns, parent role, parent columns)
FOREIGN_KEYS: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    ("orders", ("customer_id",), "customers", ("customer_id",)),
    ("order_items", ("order_id",), "orders", ("order_id",)),
    ("order_items", ("product_id",), "products", ("product_id",)),
    ("order_items", ("seller_id",), "sellers", ("seller_id",)),
    ("order_payments", ("order_id",), "orders", ("order_id",)),
    ("order_reviews", ("order_id",), "orders", ("order_id",)),
)

ROLE_SCHEMAS: dict[str, StructType] = {
    "category_translation": CATEGORY_TRANSLATION,
    "products": PRODUCTS,
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "sellers": SELLERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "geolocation": GEOLOCATION,
    "state_median_income": STATE_MEDIAN_INCOME,
}


def not_null_columns(role: str) -> tuple[str, ...]:
    return tuple(f.name for f in ROLE_SCHEMAS[role].fields if not f.nullable)
