"""Inputs of the base table built from the test-table role mapping: reviews de-duplicated,
translation patched, unknown categories filled."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.dedup import keep_latest
from ..sources import testbed
from ..sources.dimensions import fill_unknown, patch_rows
from .abt import Sources


def reviews_deduplicated(roles: testbed.Roles):
    first = ("review_id", "review_score", "review_comment_title", "review_comment_message",
             "review_creation_date", "review_answer_timestamp")
    return keep_latest(roles.order_reviews_raw, first_columns=first)


def patched_translation(roles: testbed.Roles):
    return patch_rows(roles.category_translation, testbed.TRANSLATION_PATCH)


def testbed_sources(spark: SparkSession, sf_dir: str, roles: testbed.Roles | None = None) -> Sources:
    roles = roles or testbed.Roles(spark, sf_dir)
    return Sources(
        customers=roles.customers,
        orders=roles.orders,
        order_items=roles.order_items,
        order_payments=roles.order_payments,
        order_reviews=reviews_deduplicated(roles),
        products=fill_unknown(roles.products),
        category_translation=patched_translation(roles),
        state_median_income=roles.state_median_income,
    )
