"""Cleaning and feature engineering of the base table into the modelling set.

Order of steps (it matters): drop identifiers, narrow types, drop rows without payment data,
flag and fill missing review fields, one-hot the three categorical columns, add calendar
fields, drop the raw timestamp, add the late flag. All steps are projections and one filter,
so they fuse into a single stage; only the one-hot level discovery is a separate (small) job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flag, null_flag, weekday_monday0
from . import encode

IDENTIFIERS = ("customer_unique_id", "first_order_id")
CATEGORICAL = ("primary_payment_type", "first_order_category", "customer_state")

# Target type of each column after narrowing (Spark SQL type names).
NARROW_TYPES = {
    "reordered_180d": "tinyint",
    "days_to_deliver": "float",
    "actual_vs_estimated_delivery_days": "float",
    "freight_price_ratio": "float",
    "first_order_review_score": "tinyint",
    "first_order_item_count": "smallint",
    "review_comment_flag": "tinyint",
    "review_comment_length": "smallint",
    "review_response_delay_days": "float",
    "primary_payment_type": "string",
    "count_payment_installments": "tinyint",
    "count_payment_sequential": "tinyint",
    "used_multiple_payment_types": "tinyint",
    "first_order_category": "string",
    "category_reorder_rate": "float",
    "customer_state": "string",
    "state_median_monthly_income": "int",
    "state_reorder_rate": "float",
}
FILL_ZERO = ("first_order_review_score", "review_comment_length", "review_response_delay_days")


def narrow_types(df: DataFrame, types: dict[str, str] = NARROW_TYPES) -> DataFrame:
    """Cast per the map (ANSI: an out-of-range value raises instead of wrapping). Money is
    rounded to whole units before an integer cast; other columns pass through."""
    out = []
    for f in df.schema.fields:
        target = types.get(f.name)
        c = F.col(f.name)
        if target is None:
            out.append(c)
        elif target in ("tinyint", "smallint", "int", "bigint") and f.dataType.typeName() in ("decimal", "double", "float"):
            out.append(F.round(c, 0).cast(target).alias(f.name))
        else:
            out.append(c.cast(target).alias(f.name))
    return df.select(*out)


def impute_reviews(df: DataFrame) -> DataFrame:
    """``review_missing_flag`` (1 when the score is missing), then zeros for the missing score,
    comment length and answer delay."""
    return df.withColumn("review_missing_flag", null_flag("first_order_review_score")).fillna(
        0, subset=list(FILL_ZERO))


def calendar_features(df: DataFrame, ts: str = "first_order_timestamp") -> DataFrame:
    """Month (1-12) and weekday (Monday = 0) of the first purchase."""
    return (df.withColumn("first_order_month", F.month(ts))
            .withColumn("first_order_weekday", weekday_monday0(ts)))


def add_late_flag(df: DataFrame, column: str = "actual_vs_estimated_delivery_days",
                  min_days: float = 1.0) -> DataFrame:
    """``was_late_flag``: delivered at least ``min_days`` after the estimate; NULL counts as 0."""
    return df.withColumn("was_late_flag", flag(F.col(column) >= F.lit(min_days), "tinyint"))


def clean_abt(abt: DataFrame, keep: Sequence[str] = (), levels: dict | None = None,
              one_hot_columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """The modelling set. ``keep`` retains identifier columns (e.g. a key for splitting);
    ``levels`` fixes the one-hot levels (e.g. learned on the training rows)."""
    df = abt.drop(*[c for c in IDENTIFIERS if c not in keep])
    df = narrow_types(df)
    df = df.where(F.col("primary_payment_type").isNotNull())
    df = impute_reviews(df)
    df = encode.one_hot(df, list(one_hot_columns), levels=levels, dtype="tinyint")
    df = calendar_features(df)
    df = df.drop("first_order_timestamp")
    return add_late_flag(df)
