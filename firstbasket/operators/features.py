"""First-order feature frames: delivery timing, basket, review, payment, dominant category, state.

Every frame is keyed by ``first_order_id``. Item and payment rows are aggregated per order
first: the aggregate combines partially on the map side, so only about one row per order and map
task crosses the shuffle, instead of every line. The spine then keeps its first orders with a
left join on the order id (the aggregate's output is already hash-partitioned by it). A
left-semi join would be pushed below the aggregate by the optimizer and shuffle the full lines
again, which is why the restriction is a join from the spine side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, flag, not_null_flag, safe_ratio
from ..sources.dimensions import bounded_broadcast
from .cohort import DELIVERED, ESTIMATED, PERSON

ORDER = "order_id"


def first_order_ids(spine: DataFrame) -> DataFrame:
    return spine.select(F.col("first_order_id").alias(ORDER))


def delivery_features(spine: DataFrame) -> DataFrame:
    """Days from purchase to delivery and delivery minus estimate (fractional days).

    The spine already carries the first order's dates (taken with the first order itself), so no
    second join with the orders table is needed.
    """
    return spine.select(
        PERSON, "first_order_id", "first_order_timestamp", DELIVERED, ESTIMATED,
        days_between(DELIVERED, "first_order_timestamp").alias("days_to_deliver"),
        days_between(DELIVERED, ESTIMATED).alias("actual_vs_estimated_delivery_days"))


def _dominant_key() -> "F.Column":
    """Ordering of items inside an order for the dominant category: highest price first (a missing
    price ranks first, as in a descending sort with NULLS FIRST), then item id, product id and
    seller id as tie-breakers. Only translated items take part."""
    return F.when(F.col("product_category_name_english").isNotNull(),
                  F.struct(F.col("price").isNotNull().alias("has_price"), (-F.col("price")).alias("neg_price"),
                           F.col("order_item_id"), F.col("product_id"), F.col("seller_id")))


# Largest product dimension that is broadcast to the line items (about 100 MB of rows); above it
# the lookup is a shuffle join on the product id.
PRODUCT_BROADCAST_ROWS = 2_000_000


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products whose category has a translation (inner join: the others vanish)."""
    t = translation.select("product_category_name", "product_category_name_english")
    return products.select("product_id", "product_category_name").join(t, "product_category_name", "inner")


def order_baskets(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Per order, in one aggregate: item count, price sum, freight/price ratio, and the translated
    category of the highest-priced translated item.

    ``min_by`` over a struct key replaces a row_number window: it aggregates partially on the map
    side, so an order with very many items is never gathered in one task. The product lookup is a
    broadcast join when the translated product dimension has at most ``PRODUCT_BROADCAST_ROWS``
    rows (checked by a bounded count), so the lines are never shuffled by product; above the
    bound it is a shuffle join.
    """
    lines = items.select(ORDER, "order_item_id", "product_id", "seller_id", "price", "freight_value")
    lookup = bounded_broadcast(translated_products(products, translation), PRODUCT_BROADCAST_ROWS)
    tagged = lines.join(lookup, "product_id", "left")
    return tagged.groupBy(ORDER).agg(
        F.count("order_item_id").alias("first_order_item_count"),
        F.sum("price").cast("decimal(38,2)").alias("first_order_price"),
        safe_ratio(F.sum("freight_value"), F.sum("price")).alias("freight_price_ratio"),
        F.min_by("product_category_name", _dominant_key()).alias("first_order_category_portuguese"),
        F.min_by("product_category_name_english", _dominant_key()).alias("first_order_category"),
    )


def first_order_baskets(spine: DataFrame, items: DataFrame, products: DataFrame,
                        translation: DataFrame) -> DataFrame:
    """:func:`order_baskets` of the spine's first orders (keyed ``order_id``)."""
    keys = first_order_ids(spine)
    return keys.join(order_baskets(items, products, translation), ORDER, "inner")


def item_features(spine: DataFrame, items: DataFrame) -> DataFrame:
    """COUNT / SUM / ratio of the first order's items; 0 items and NULL sums when it has none."""
    agg = items.select(ORDER, "order_item_id", "price", "freight_value").groupBy(ORDER).agg(
        F.count("order_item_id").alias("first_order_item_count"),
        F.sum("price").cast("decimal(38,2)").alias("first_order_price"),
        safe_ratio(F.sum("freight_value"), F.sum("price")).alias("freight_price_ratio"))
    return (spine.select(PERSON, "first_order_id")
            .join(agg.withColumnRenamed(ORDER, "first_order_id"), "first_order_id", "left")
            .select(PERSON, "first_order_id",
                    F.coalesce("first_order_item_count", F.lit(0)).cast("bigint").alias("first_order_item_count"),
                    "first_order_price", "freight_price_ratio"))


def dominant_category(spine: DataFrame, items: DataFrame, products: DataFrame,
                      translation: DataFrame) -> DataFrame:
    """Persons whose first order has at least one translated item, with the category of the
    highest-priced one (inner-join semantics: the others have no row)."""
    baskets = first_order_baskets(spine, items, products, translation)
    return (spine.select(PERSON, "first_order_id")
            .join(baskets.withColumnRenamed(ORDER, "first_order_id"), "first_order_id", "inner")
            .where(F.col("first_order_category").isNotNull())
            .select(PERSON, "first_order_id", "first_order_category_portuguese", "first_order_category"))


def review_features(spine: DataFrame, reviews: DataFrame) -> DataFrame:
    """Score, comment flag, comment length and answer delay of the first order's review (the review
    table must already hold at most one row per order). No review: flag 0, the rest NULL."""
    r = reviews.select(F.col(ORDER).alias("first_order_id"), "review_score", "review_comment_message",
                       "review_creation_date", "review_answer_timestamp")
    return (spine.select(PERSON, "first_order_id").join(r, "first_order_id", "left")
            .select(PERSON, "first_order_id",
                    F.col("review_score").alias("first_order_review_score"),
                    not_null_flag("review_comment_message").alias("review_comment_flag"),
                    F.length("review_comment_message").alias("review_comment_length"),
                    days_between("review_answer_timestamp", "review_creation_date")
                    .alias("review_response_delay_days")))


def payment_aggregates(spine: DataFrame, payments: DataFrame) -> DataFrame:
    """Per order (the spine's left join keeps the first orders): most frequent payment type (ties -> smallest), max installments, max
    sequence number, and whether more than one type was used.

    ``min(type) < max(type)`` is the same test as ``count(DISTINCT type) > 1`` but needs no
    distinct-aggregate expansion (no Expand, no second shuffle).
    """
    return order_payments(payments)


def order_payments(payments: DataFrame) -> DataFrame:
    """Per-order payment aggregates (see :func:`payment_aggregates`)."""
    p = payments.select(ORDER, "payment_type", "payment_installments", "payment_sequential")
    return p.groupBy(ORDER).agg(
        F.mode("payment_type", True).alias("primary_payment_type"),
        F.max("payment_installments").alias("count_payment_installments"),
        F.max("payment_sequential").alias("count_payment_sequential"),
        flag(F.min("payment_type") < F.max("payment_type")).alias("used_multiple_payment_types"))


def payment_features(spine: DataFrame, payments: DataFrame) -> DataFrame:
    agg = payment_aggregates(spine, payments).withColumnRenamed(ORDER, "first_order_id")
    return (spine.select(PERSON, "first_order_id").join(agg, "first_order_id", "left")
            .select(PERSON, "first_order_id", "primary_payment_type", "count_payment_installments",
                    "count_payment_sequential",
                    F.coalesce("used_multiple_payment_types", F.lit(0)).alias("used_multiple_payment_types")))


def state_base(spine: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Each spine person with the state of the customer id behind the first order. The spine
    already carries it; pass ``customers`` to look it up again instead (left join)."""
    if customers is None:
        return spine.select("customer_id", PERSON, "first_order_id", "customer_state")
    c = customers.select("customer_id", "customer_state")
    return spine.select("customer_id", PERSON, "first_order_id").join(c, "customer_id", "left")
