"""Dimension maintenance: literal rows appended to a table, NULL categories filled, and a
broadcast hint that is only given behind a size check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN_CATEGORY = "unknown_category"


def patch_rows(df: DataFrame, rows: Iterable[Sequence], replace: bool = False) -> DataFrame:
    """``df`` plus literal rows (bound by column position). With ``replace`` a literal row
    replaces an existing row with the same first-column key instead of duplicating it."""
    rows = [tuple(r) for r in rows]
    if not rows:
        return df
    extra = df.sparkSession.createDataFrame(rows, schema=df.schema)
    if replace:
        df = df.join(extra.select(df.columns[0]), df.columns[0], "left_anti")
    return df.unionByName(extra)


def fill_unknown(df: DataFrame, column: str = "product_category_name",
                 value: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Replace NULLs of one column by a constant (an UPDATE ... WHERE col IS NULL)."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after checking that ``df`` has at most ``max_rows`` rows.

    The check runs one cheap job (``limit(max_rows + 1).count()``); above the bound the frame is
    returned unhinted and the planner (and AQE, from runtime sizes) chooses the join.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
