"""Target (group-rate) encoding and one-hot encoding.

Group rates have one row per distinct key; they are joined back without a broadcast hint, so
AQE converts the join to a broadcast at run time when the materialised rate table is small and
keeps a shuffle join (with skew splitting) when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_rate(df: DataFrame, key: str, label: str, prefix: str) -> DataFrame:
    """key, ``{prefix}_customer_count``, ``{prefix}_reorder_count``, ``{prefix}_reorder_rate``.

    Counts are BIGINT and the rate is their DOUBLE quotient (one division, exact operands).
    """
    n = F.count(F.lit(1))
    positives = F.sum(F.col(label)).cast("bigint")
    return df.groupBy(key).agg(
        n.alias(f"{prefix}_customer_count"),
        positives.alias(f"{prefix}_reorder_count"),
        (positives.cast("double") / n.cast("double")).alias(f"{prefix}_reorder_rate"))


def target_encode(df: DataFrame, key: str, label: str, prefix: str,
                  fit_on: Column | None = None, keep_counts: bool = False, rates_from: DataFrame | None = None) -> DataFrame:
    """Adds ``{prefix}_reorder_rate``: the label mean of the row's group.

    ``fit_on`` restricts the rows the rates are learned from (e.g. the training split) while every
    row still receives its group's rate; by default all rows are used, as the original pipeline did.
    NULL keys never receive a rate. ``rates_from`` is the frame to learn them from where ``df`` already
    has further joins that the rates don't need.
    """
    df_fit = df if rates_from is None else rates_from
    fit = df_fit if fit_on is None else df_fit.where(fit_on)
    rates = group_rate(fit.where(F.col(key).isNotNull()), key, label, prefix)
    if not keep_counts:
        rates = rates.select(key, f"{prefix}_reorder_rate")
    return df.join(rates, key, "left")


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The encoding in sparse form, one row (key, column_name, level) per non-null value: its size
    follows the rows, whatever the number of levels."""
    return df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in columns])).alias("kv")
    ).select(key, "kv.column_name", "kv.level").where(F.col("level").isNotNull())


def one_hot_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-null levels per column, found in one distributed pass.

    The level lists become column names, so they are fetched to the driver; their size is the
    number of columns of the dense frame, not the number of rows. For columns with very many levels
    ``one_hot_long`` and the sparse Spark ML encoding in ``operators.model`` need no such list.
    """
    if not columns:
        return {}
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]))
        .alias("kv")).select("kv.column", "kv.level").where(F.col("level").isNotNull()).distinct()
    levels: dict[str, list] = {c: [] for c in columns}
    for row in stacked.collect():
        levels[row["column"]].append(row["level"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, columns: Sequence[str], levels: dict[str, list] | None = None,
            dtype: str = "tinyint", drop: bool = True) -> DataFrame:
    """One 0/1 column ``{column}_{level}`` per level; a NULL value gives zeros in every column of
    its group and no level is dropped. Columns keep the input order, levels are sorted."""
    levels = levels if levels is not None else one_hot_levels(df, columns)
    new_cols = []
    for c in columns:
        for level in levels[c]:
            new_cols.append(flag(F.col(c).cast("string") == F.lit(level), dtype).alias(f"{c}_{level}"))
    kept = [F.col(c) for c in df.columns if not (drop and c in columns)]
    return df.select(*kept, *new_cols)


def flag(predicate: Column, dtype: str) -> Column:
    return F.coalesce(predicate, F.lit(False)).cast(dtype)
