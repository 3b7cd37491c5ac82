"""Profiling: shape, distinct / null / non-null counts, numeric and categorical summaries,
exact quantiles, value counts and shares, type families, equal-width histograms and
correlation with the label.

Wide-to-long reshaping uses ``explode(array(struct(...)))`` so one scan serves every column.
Exact quantiles use running counts over the distinct values (``metrics.running_totals``) instead of the
``percentile`` aggregate, whose buffer holds every distinct value of a column in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from .metrics import running_totals

ROUND = 6


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def _long(df: DataFrame, columns: Sequence[str], cast: str | None = None) -> DataFrame:
    """(column_name, value) pairs for the given columns, one scan."""
    def val(c):
        return F.col(c).cast(cast) if cast else F.col(c)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), val(c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.value")


def frame_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column: (column, value) pairs are de-duplicated with a
    partial aggregate and counted per column (no per-column distinct expansion). ``approx`` uses
    HyperLogLog (``approx_count_distinct``, relative error ``rsd``) in one pass instead, for
    id-like columns on very large tables where every distinct pair would cross the shuffle."""
    columns = list(columns or df.columns)
    if approx:
        counts = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns])
        return counts.select(F.explode(pairs).alias("p")).select("p.*")
    return (_long(df, columns, "string").where(F.col("value").isNotNull())
            .distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def non_null_counts(df: DataFrame) -> DataFrame:
    """(column, Spark type, non-null rows): the info() listing without memory figures."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                               F.col(c).alias("non_null_rows")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column_name, prob, value): linear interpolation between the order statistics at
    ``floor(h)`` and ``ceil(h)``, ``h = (n - 1) * prob``, over non-null values.

    Rows are counted per (column, value) first, partially on the map side, so a value that half of
    the rows share is one row a task; running counts over the distinct values then find the wanted
    positions. Per-column counts and the wanted positions are at most ``len(columns) *
    len(probs) * 2`` rows, so they are broadcast. -0.0 counts as 0.0.
    """
    long = _long(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    placed = running_totals(counts, [F.col("column_name"), F.col("value")], ["rows"])
    upto = F.col("cum_rows")
    stats = placed.groupBy("column_name").agg(F.min(upto - F.col("rows")).alias("start"), F.sum("rows").alias("n"))
    wanted = (stats.withColumn("prob", F.explode(F.array(*[F.lit(float(x)) for x in probs])))
              .withColumn("h", (F.col("n") - 1).cast("double") * F.col("prob"))
              .withColumn("pos", F.explode(F.array(F.floor("h").cast("bigint"), F.ceil("h").cast("bigint"))))
              .select("column_name", "prob", (F.col("start") + F.col("pos")).alias("pos"),
                      (F.col("h") - F.floor("h")).alias("frac")).distinct())
    found = (placed.withColumnRenamed("column_name", "_c")
             .join(F.broadcast(wanted), (F.col("_c") == F.col("column_name")) & (F.col("pos") < upto)
                   & (F.col("pos") >= upto - F.col("rows")), "inner"))
    lo, hi = F.min_by("value", "pos"), F.max_by("value", "pos")
    return found.groupBy("column_name", "prob", "frac").agg(lo.alias("lo"), hi.alias("hi")).select(
        "column_name", "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value"))


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10_000) -> DataFrame:
    """(column_name, prob, value) from ``percentile_approx`` in one pass (no global sort); the
    rank error is at most ``1 / accuracy`` of the rows. For very large tables when exact order
    statistics are not needed."""
    long = _long(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    q = long.groupBy("column_name").agg(
        F.percentile_approx("value", [float(x) for x in probs], accuracy).alias("qs"))
    return q.select("column_name", F.posexplode("qs").alias("i", "value")).select(
        "column_name", F.element_at(F.array(*[F.lit(float(x)) for x in probs]), F.col("i") + 1).alias("prob"),
        "value")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     probs: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True) -> DataFrame:
    """Per numeric column: count, mean, sample std, min, quartiles, max (rounded to 6 places).
    ``exact=False`` takes the quartiles from :func:`approx_quantiles` (one pass, no sort)."""
    columns = list(columns or numeric_columns(df))
    long = _long(df, columns, "double").where(F.col("value").isNotNull())
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), ROUND).alias("mean"),
        F.round(F.stddev_samp("value"), ROUND).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(df, columns, probs) if exact else approx_quantiles(df, columns, probs)
    wide = q.groupBy("column_name").pivot("prob", [float(x) for x in probs]).agg(F.first("value"))
    for x in probs:
        wide = wide.withColumnRenamed(str(float(x)), f"p{int(round(x * 100))}")
    pcols = [f"p{int(round(x * 100))}" for x in probs]
    wide = wide.select("column_name", *[F.round(c, ROUND).alias(c) for c in pcols])
    return moments.join(wide, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *pcols, "max")


EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def datetime_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if type_family(f.dataType) == "datetime" and f.name not in exclude]


def as_micros(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Date and time columns as microseconds since 1970, for the numeric summaries (:func:`histogram`)."""
    columns = list(columns or datetime_columns(df))
    return df.select(*[F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, CAST(`{c}` AS TIMESTAMP_NTZ))").alias(c) for c in columns])


def describe_datetime(df: DataFrame, columns: Sequence[str] | None = None,
                      probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per date or time column: count, distinct values, min, quartiles (to the microsecond) and max."""
    micros = as_micros(df, columns)
    columns = micros.columns

    def back(c):
        return F.timestamp_add("MICROSECOND", F.round(F.col(c)).cast("bigint"), F.expr(EPOCH)).alias(c)
    values = _long(micros, columns).where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    extremes = values.groupBy("column_name").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                                 F.min("value").alias("min"), F.max("value").alias("max"))
    names = [f"p{int(round(x * 100))}" for x in probs]
    wide = exact_quantiles(micros, columns, probs).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(x)), F.col("value"))).alias(p) for x, p in zip(probs, names)])
    return extremes.join(wide, "column_name").select("column_name", "count", "unique",
                                                     *[back(c) for c in ["min", *names, "max"]])


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column: non-null count, distinct values, most frequent value (ties: smallest)
    and its frequency."""
    columns = list(columns or string_columns(df))
    freq = (_long(df, columns, "string").where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    return freq.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their row counts, most frequent first (ties by value)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(column).asc()))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each non-null value among non-null rows; the total is a scalar subquery."""
    base = df.where(F.col(column).isNotNull())
    total = base.select(F.count(F.lit(1))).scalar()
    return (base.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .select(column, (F.col("n").cast("double") / total.cast("double")).alias("share")))


def type_family(dtype) -> str:
    if isinstance(dtype, (NumericType, BooleanType)):
        return "numeric"
    if isinstance(dtype, StringType):
        return "categorical"
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return "datetime"
    return "other"


def type_family_counts(df: DataFrame) -> DataFrame:
    """Per type family (numeric, categorical, datetime, other): the number of columns (from the
    schema) and the number of non-null cells (one pass over the data)."""
    fams: dict[str, list[str]] = {}
    for f in df.schema.fields:
        fams.setdefault(type_family(f.dataType), []).append(f.name)
    counts = df.agg(*[sum((F.count(F.col(c)) for c in cols), F.lit(0)).cast("bigint").alias(fam)
                      for fam, cols in fams.items()])
    pairs = F.array(*[F.struct(F.lit(fam).alias("family"), F.lit(len(cols)).alias("columns"),
                               F.col(fam).alias("non_null_cells")) for fam, cols in sorted(fams.items())])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width histogram per numeric column: (column, bin 1..bins, lower, upper, n), empty bins
    included; the maximum falls in the last bin. The grid of bins is ``len(columns) * bins`` rows."""
    columns = list(columns or numeric_columns(df))
    long = _long(df, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    rng = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    binned = (long.join(F.broadcast(rng), "column_name")
              .withColumn("bin", F.when(width == 0, F.lit(1)).otherwise(
                  F.least(F.lit(bins), (F.floor((F.col("value") - F.col("lo")) * F.lit(bins) / width) + 1)
                          .cast("int"))))
              .groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = (rng.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
            .withColumn("lower", F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / F.lit(bins))
            .withColumn("upper", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / F.lit(bins)))
    return (grid.join(binned, ["column_name", "bin"], "left")
            .select("column_name", "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")))


def label_correlation(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each numeric column with ``label`` over rows where both are present;
    NULL when either side is constant there (ANSI-safe: ``try_divide``). Rounded to 6 places.

    The frame is reshaped to (feature, x, y) and grouped by feature: three aggregate functions
    regardless of the width (one wide aggregate with three functions per column falls out of
    whole-stage code generation once there are dozens of one-hot columns); partial aggregation
    leaves one row per feature and map task to shuffle.
    """
    columns = [c for c in (columns or numeric_columns(df)) if c != label]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])
    long = (df.select(F.col(label).cast("double").alias("y"), F.explode(pairs).alias("p"))
            .select("p.feature", "p.x", "y"))
    xp = F.when(F.col("y").isNotNull(), F.col("x"))
    yp = F.when(F.col("x").isNotNull(), F.col("y"))
    corr = F.try_divide(F.covar_samp(xp, yp), F.stddev_samp(xp) * F.stddev_samp(yp))
    return long.groupBy("feature").agg(F.round(corr, ROUND).alias("corr"))


def correlation_extremes(corr: DataFrame, k: int = 10) -> DataFrame:
    """Top-k and bottom-k signed correlations (NULLs excluded), with side and rank."""
    c = corr.where(F.col("corr").isNotNull())
    top = c.withColumn("rank", F.row_number().over(Window.orderBy(F.col("corr").desc(), F.col("feature"))))
    bottom = c.withColumn("rank", F.row_number().over(Window.orderBy(F.col("corr").asc(), F.col("feature"))))
    return (top.where(F.col("rank") <= k).withColumn("side", F.lit("top"))
            .unionByName(bottom.where(F.col("rank") <= k).withColumn("side", F.lit("bottom"))))


def correlation_top_abs(corr: DataFrame, k: int = 25) -> DataFrame:
    """The k strongest absolute correlations (a top-k report over one row per feature)."""
    return (corr.where(F.col("corr").isNotNull())
            .withColumn("abs_corr", F.abs("corr"))
            .orderBy(F.col("abs_corr").desc(), F.col("feature").asc()).limit(k))
