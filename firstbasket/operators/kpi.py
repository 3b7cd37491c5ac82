"""KPI tables behind the retention dashboard, computed from the reporting view.

Every KPI is one aggregate (customers, reorders, reorder rate) over a grouping expression; the
grouped tables have one row per group value, so ranking them uses a window over that small
result, never over customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flag

LABEL = "reordered_180d"


def _rate_aggs(label: str = LABEL) -> list[Column]:
    n = F.count(F.lit(1))
    pos = F.sum(F.col(label)).cast("bigint")
    return [n.alias("customers"), pos.alias("reorders"),
            (pos.cast("double") / n.cast("double")).alias("reorder_rate")]


def late_flag(days_late: str = "actual_vs_estimated_delivery_days", min_days: float = 1.0) -> Column:
    """1 when delivery came at least ``min_days`` after the estimate; NULL counts as on time."""
    return flag(F.col(days_late) >= F.lit(min_days), "tinyint")


def overall(bi: DataFrame) -> DataFrame:
    return bi.agg(*_rate_aggs())


def by(bi: DataFrame, key: Column | str, name: str | None = None) -> DataFrame:
    key_c = F.col(key) if isinstance(key, str) else key
    return bi.groupBy(key_c.alias(name or str(key))).agg(*_rate_aggs())


def monthly(bi: DataFrame) -> DataFrame:
    return by(bi, F.date_trunc("month", "first_order_timestamp").cast("timestamp_ntz"), "first_order_month")


def late_vs_on_time(bi: DataFrame) -> DataFrame:
    return by(bi, late_flag(), "was_late_flag")


def ranked_categories(bi: DataFrame) -> DataFrame:
    """Reorder rate per first-order category, with its rank (1 = highest rate, ties by name)."""
    g = by(bi, "first_order_category").where(F.col("first_order_category").isNotNull())
    w = Window.orderBy(F.col("reorder_rate").desc(), F.col("first_order_category").asc())
    return g.withColumn("category_rank", F.row_number().over(w))


def overview(bi: DataFrame) -> DataFrame:
    """Customers, average first-order price and items, average review score and late share."""
    n = F.count(F.lit(1))
    return bi.agg(
        n.alias("customers"),
        (F.sum("first_order_price").cast("double") / F.count("first_order_price").cast("double"))
        .alias("avg_first_order_price"),
        (F.sum("first_order_item_count").cast("double") / n.cast("double")).alias("avg_item_count"),
        (F.sum("first_order_review_score").cast("double") / F.count("first_order_review_score").cast("double"))
        .alias("avg_review_score"),
        (F.sum(late_flag()).cast("double") / n.cast("double")).alias("late_share"),
        (F.sum(LABEL).cast("double") / n.cast("double")).alias("reorder_rate"))
