"""Label-stratified train/test split and stratified k-fold assignment, seeded and exact.

Rows are ordered inside each label by ``md5(key || ':' || seed)`` (then by key), which is the same
in Spark and in SQL engines, so the split is reproducible anywhere. Positions inside a label
come from ``rank.segment_row_number``, never from a window partitioned by the label or a shuffle on
it: 97 % of rows share one label, and either would run in one task. Label sizes are broadcast behind
a check of their number. Rows with a NULL label are a group of their own.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import segment_row_number


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{int(seed)}")))


def rank_within_label(df: DataFrame, label: str, key: str, seed: int, out_col: str = "label_rank") -> DataFrame:
    """Adds ``out_col`` (0-based position inside the label) and ``label_rows``."""
    ranked = segment_row_number(df, [label], [hash_order(key, seed), F.col(key)], out_col="_row", size_col="label_rows")
    return ranked.withColumn(out_col, F.col("_row") - 1).drop("_row")


def _ceil_share(n: Column, share: float) -> Column:
    """ceil(n * share) in exact integer arithmetic (share as a reduced fraction)."""
    fr = Fraction(share).limit_denominator(10_000)
    return F.floor((n * F.lit(fr.numerator) + F.lit(fr.denominator - 1)) / F.lit(fr.denominator)).cast("bigint")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42,
                     out_col: str = "is_test", folds: int | None = None, fold_col: str = "fold") -> DataFrame:
    """``out_col`` = 1 for the first ``ceil(test_share * n_label)`` rows of each label in hash order.

    With ``folds``, training rows also get ``fold_col`` from the same pass: they are the label's
    rows after the test block, so their rank among training rows is ``rank - n_test`` and the fold
    is that rank modulo ``folds`` (exactly what :func:`stratified_folds` gives on the training
    rows, without a second ranking). Test rows get a NULL fold.
    """
    ranked = rank_within_label(df, label, key, seed)
    n_test = _ceil_share(F.col("label_rows"), test_share)
    out = ranked.withColumn(out_col, (F.col("label_rank") < n_test).cast("int"))
    if folds:
        out = out.withColumn(fold_col, F.when(F.col(out_col) == 0,
                                              ((F.col("label_rank") - n_test) % F.lit(int(folds))).cast("int")))
    return out.drop("label_rank", "label_rows")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42,
                     out_col: str = "fold") -> DataFrame:
    """Fold 0..k-1 dealt round-robin over each label's hash order (sizes differ by at most one)."""
    ranked = rank_within_label(df, label, key, seed)
    return (ranked.withColumn(out_col, (F.col("label_rank") % F.lit(k)).cast("int"))
            .drop("label_rank", "label_rows"))
