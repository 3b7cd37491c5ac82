"""Data-quality checks that replace database constraints: key uniqueness, orphans, not-null,
and a dense surrogate key.

Each check returns a DataFrame (violations or counts); nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import with_global_position


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (primary-key check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def unique_key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, key_columns, key_values, row_count) of the keys that occur more than once, over all
    ``tables``; the values are strings in the order of the columns."""
    parts = [unique_key_violations(df, keys[t]).select(
        F.lit(t).alias("table_name"), F.lit(",".join(keys[t])).alias("key_columns"),
        F.array(*[F.col(c).cast("string") for c in keys[t]]).alias("key_values"), "row_count") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
            parent_cols: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row (left anti join)."""
    parent_cols = list(parent_cols or child_cols)
    p = parent.select(*[F.col(pc).alias(f"_p{i}") for i, pc in enumerate(parent_cols)]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(cc) == F.col(f"_p{i}") for i, cc in enumerate(child_cols)])
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols])
    return child.where(not_null).join(p, cond, "left_anti")


def orphan_report(links: Sequence[tuple[str, Sequence[str], str, Sequence[str]]],
                  tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per foreign-key link: child, key columns, parent and number of orphan rows."""
    parts = []
    for child, ccols, parent, pcols in links:
        # Counts per key first (partial on the map side): a hot key is one row in the anti join.
        counts = tables[child].groupBy(*ccols).agg(F.count(F.lit(1)).alias("_n"))
        n = orphans(counts, tables[parent], ccols, pcols).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        parts.append(n.select(F.lit(child).alias("child_table"), F.lit(",".join(ccols)).alias("child_columns"),
                              F.lit(parent).alias("parent_table"), "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def null_report(df: DataFrame, columns: Sequence[str], table: str = "") -> DataFrame:
    """(table, column, null_rows) for each column, from a single pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select(
        F.lit(table).alias("table_name"), "p.column_name", "p.null_rows")


def not_null_violations(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Null counts of every NOT NULL column of every table."""
    return reduce(DataFrame.unionByName,
                  [null_report(tables[t], cols, t) for t, cols in required.items() if cols])


def surrogate_key(df: DataFrame, order: Sequence, name: str = "sk") -> DataFrame:
    """Dense 1..n BIGINT key following ``order`` (which must be a total order).

    Uses the distributed position (range partitioning + per-partition offsets), not a global
    window, so no single task sees all rows. For keys where gaps are acceptable,
    ``monotonically_increasing_id`` is cheaper.
    """
    return with_global_position(df, order, pos_col="_pos").select(
        (F.col("_pos") + 1).alias(name), *df.columns)
