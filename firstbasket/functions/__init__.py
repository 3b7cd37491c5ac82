"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from .columns import (
    days_between,
    flag,
    not_null_flag,
    null_flag,
    ratio,
    safe_ratio,
    ts_literal,
    weekday_monday0,
)

__all__ = [
    "days_between", "flag", "not_null_flag", "null_flag", "ratio", "safe_ratio",
    "ts_literal", "weekday_monday0",
]
