"""Scalar expressions shared by the operators.

All of them compile to Catalyst expressions, so they stay inside
whole-stage code generation and fold to constants where possible.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def ts_literal(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; comparing NTZ columns to it keeps the filter pushable."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """(later - earlier) in fractional days, NULL when either side is NULL."""
    later_c = F.col(later) if isinstance(later, str) else later
    earlier_c = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.timestamp_diff("MICROSECOND", earlier_c, later_c).cast("double") / F.lit(MICROS_PER_DAY)


def weekday_monday0(ts: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(F.col(ts) if isinstance(ts, str) else ts)


def flag(predicate: Column, dtype: str = "int") -> Column:
    """1 when the predicate holds, 0 when it is false or NULL."""
    return F.coalesce(predicate, F.lit(False)).cast(dtype)


def not_null_flag(c: str | Column, dtype: str = "int") -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNotNull().cast(dtype)


def null_flag(c: str | Column, dtype: str = "tinyint") -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNull().cast(dtype)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when the denominator is 0 or NULL (no ANSI error)."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Alias of :func:`safe_ratio` kept for readability at call sites that count rows."""
    return safe_ratio(num, den)
