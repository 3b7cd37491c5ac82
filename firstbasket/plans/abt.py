"""The analytical base table (one row per person) and the reporting view over it.

Plan shape: the spine is built once (aggregate by person) and everything else is joined to it on
``first_order_id``, items and payments after an aggregate by order. The two group rates are joined back
without hints so that AQE can pick a broadcast from their measured size.

The person-grain rows behind both are one written Parquet table. Whoever needs no rate, such as the
reporting view and the dashboard, takes :func:`base_rows` instead, which runs no job while a query is
planned: Catalyst drops the feature joins and the columns that a query doesn't ask for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import days_between, not_null_flag
from ..operators import cohort, encode, features
from ..operators.cohort import PERSON
from ..session import checkpoint_dir
from ..sources import files

ABT_COLUMNS = (
    "customer_unique_id", "first_order_id", "first_order_timestamp",
    "reordered_180d",
    "days_to_deliver", "actual_vs_estimated_delivery_days",
    "first_order_item_count", "first_order_price", "freight_price_ratio",
    "first_order_review_score", "review_comment_flag",
    "review_comment_length", "review_response_delay_days",
    "primary_payment_type", "count_payment_installments",
    "count_payment_sequential", "used_multiple_payment_types",
    "first_order_category", "category_reorder_rate",
    "customer_state", "state_median_monthly_income",
    "state_reorder_rate",
)

BI_COLUMNS = (
    "customer_unique_id", "reordered_180d", "first_order_timestamp", "first_order_category",
    "first_order_price", "first_order_item_count", "customer_state", "first_order_review_score",
    "actual_vs_estimated_delivery_days",
)


@dataclass
class Sources:
    """The eight inputs of the base table (reviews already de-duplicated, translation patched)."""
    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    products: DataFrame
    category_translation: DataFrame
    state_median_income: DataFrame


def labelled_spine(src: Sources, cfg: Config) -> DataFrame:
    delivered = cohort.delivered_orders(src.orders, src.customers, cfg)
    spine = cohort.first_order_spine(delivered, cfg)
    return cohort.reorder_label(spine, delivered, cfg)


def _wide(src: Sources, cfg: Config) -> DataFrame:
    """The spine with label, basket, payment and review columns, one row per person."""
    baskets = (features.order_baskets(src.order_items, src.products, src.category_translation)
               .withColumnRenamed("order_id", "first_order_id"))
    payments = features.order_payments(src.order_payments).withColumnRenamed("order_id", "first_order_id")
    reviews = src.order_reviews.select(
        F.col("order_id").alias("first_order_id"), "review_score", "review_comment_message",
        "review_creation_date", "review_answer_timestamp")
    return (labelled_spine(src, cfg)
            .join(baskets, "first_order_id", "left")
            .join(payments, "first_order_id", "left")
            .join(reviews, "first_order_id", "left"))


def _own_columns() -> list:
    """The base table's columns that come from a person's own rows, in order; rates and income come apart."""
    return [
        PERSON, "first_order_id", "first_order_timestamp", "reordered_180d",
        days_between(cohort.DELIVERED, "first_order_timestamp").alias("days_to_deliver"),
        days_between(cohort.DELIVERED, cohort.ESTIMATED).alias("actual_vs_estimated_delivery_days"),
        F.coalesce("first_order_item_count", F.lit(0)).cast("bigint").alias("first_order_item_count"),
        "first_order_price", "freight_price_ratio",
        F.col("review_score").alias("first_order_review_score"),
        not_null_flag("review_comment_message").alias("review_comment_flag"),
        F.length("review_comment_message").alias("review_comment_length"),
        days_between("review_answer_timestamp", "review_creation_date").alias("review_response_delay_days"),
        "primary_payment_type", "count_payment_installments", "count_payment_sequential",
        F.coalesce("used_multiple_payment_types", F.lit(0)).alias("used_multiple_payment_types"),
        "first_order_category", "customer_state",
    ]


def base_rows(src: Sources, cfg: Config) -> DataFrame:
    """The base table without the rates and the income: a plan over the sources, nothing is run."""
    return _wide(src, cfg).select(*_own_columns())


def build_abt(src: Sources, cfg: Config, checkpoint: bool = True) -> DataFrame:
    """22 columns, one row per person with a first delivered order before the cut-off.

    The person-grain rows are read three times (the star assembly and the two group rates that
    are learned from them and joined back). With ``checkpoint`` they are written once, as a Parquet table
    in the session's checkpoint folder: spine, label and feature aggregates run once, a lost executor
    re-reads files, and each reader scans only the columns it asks for (a rate: two) and knows their
    real size. Without it, Spark re-derives the rows in each branch (their column sets
    differ, so exchanges are not reused).
    """
    rows = base_rows(src, cfg)
    if checkpoint:
        rows = files.materialize(rows, f"{checkpoint_dir(rows.sparkSession).rstrip('/')}/base-{uuid.uuid4().hex}")
    income = src.state_median_income.select(
        F.col("state_code").alias("customer_state"),
        F.col("median_monthly_income_2017").alias("state_median_monthly_income"))
    rated = encode.target_encode(rows, "first_order_category", "reordered_180d", "category")
    rated = encode.target_encode(rated, "customer_state", "reordered_180d", "state", rates_from=rows)
    return rated.join(income, "customer_state", "left").select(*ABT_COLUMNS)


def bi_view(abt: DataFrame, name: str | None = None) -> DataFrame:
    """The nine-column reporting projection; registered as a temp view when ``name`` is given."""
    view = abt.select(*BI_COLUMNS)
    if name:
        view.createOrReplaceTempView(name)
    return view


def for_export(abt: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Globally ordered by person for export: range partitioning plus a per-partition sort
    (the parallel form of ORDER BY)."""
    n = num_partitions or abt.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return abt.repartitionByRange(int(n), PERSON).sortWithinPartitions(PERSON)
