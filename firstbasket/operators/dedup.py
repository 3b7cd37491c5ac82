"""Review de-duplication: keep the latest review per order, list duplicate groups, rank duplicate keys.

"Latest" follows the original export: rows sorted by answer time with missing times last, the
last row per order kept, so a review without an answer time wins; remaining ties go to the
highest review id. Implemented as ``max_by`` over a struct key (partial aggregation, no
window), so a key with millions of duplicates is reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str = "order_id", ts: str = "review_answer_timestamp",
                tiebreak: str = "review_id", first_columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per ``key``; the key column comes first, then ``first_columns`` (if given), then the rest."""
    rest = [c for c in df.columns if c != key]
    rank = F.struct(F.col(ts).isNull().alias("no_ts"), F.col(ts).alias("ts"), F.col(tiebreak).alias("tb"))
    kept = df.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(key, "r.*")
    order = [key] + list(first_columns or ()) + [c for c in rest if c not in (first_columns or ())]
    return kept.select(*order)


def duplicate_rows(df: DataFrame, key: str = "order_id", sort_by: str | None = None) -> DataFrame:
    """All members of groups whose key occurs more than once, with the group size; ``sort_by``
    orders them for display (ascending, missing values last).

    The group sizes are counted with a partial aggregate and joined back on the key (AQE splits a
    hot key's partition), instead of a count window that would gather a whole group in one task.
    """
    sizes = (df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count"))
             .where(F.col("duplicate_count") > 1))
    out = df.join(sizes, key, "inner")
    return out.orderBy(F.col(sort_by).asc_nulls_last(), F.col(key)) if sort_by else out


def duplicate_key_counts(df: DataFrame, key: str = "order_id", k: int = 5) -> DataFrame:
    """The ``k`` most duplicated keys (count descending, key ascending): a top-k report."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1)
            .orderBy(F.col("n").desc(), F.col(key).asc())
            .limit(k))
