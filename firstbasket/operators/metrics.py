"""Evaluation of a (label, score) frame: confusion matrix, classification report, ROC-AUC, ROC
curve, threshold sweep, deciles and lift.

Everything is an aggregate over the scored rows. Ranks and running totals use range
partitioning (``rank.with_global_position`` / :func:`running_totals`); only frames with one row
per threshold, class or decile are ever small enough to be ordered without a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import checkpoint_dir
from .rank import with_deciles, with_global_position

ROUND = 6


def _div(num: Column, den: Column) -> Column:
    """num / den as double; 0 when the denominator is 0 (the usual zero-division convention)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_counts(df: DataFrame, label: str, pred: str | Column) -> DataFrame:
    p = F.col(pred) if isinstance(pred, str) else pred
    y = F.col(label)
    return df.agg(F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
                  F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
                  F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
                  F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"))


def classification_report(df: DataFrame, label: str, pred: str | Column) -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision, recall, f1, support."""
    return confusion_counts(df, label, pred).select(F.explode(_report_rows()).alias("r")).select("r.*")


def _report_rows() -> Column:
    """The rows of a classification report, as an array, from the counts tn, fp, fn and tp."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    p0, r0, f0 = _div(tn, tn + fn), _div(tn, tn + fp), _div(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = _div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn)
    n = s0 + s1

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("bigint").alias("support"))

    return F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), _div(tn + tp, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f0 * s0 + f1 * s1, n), n))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """For each threshold t (predict 1 when score >= t): tn, fp, fn, tp and the positive class's
    precision, recall, f1 plus accuracy. One pass: four conditional counts per threshold."""
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [F.count_if((y == 0) & ~hit).cast("bigint").alias(f"tn{i}"),
                 F.count_if((y == 0) & hit).cast("bigint").alias(f"fp{i}"),
                 F.count_if((y == 1) & ~hit).cast("bigint").alias(f"fn{i}"),
                 F.count_if((y == 1) & hit).cast("bigint").alias(f"tp{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tn{i}").alias("tn"),
                              F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"),
                              F.col(f"tp{i}").alias("tp")) for i, t in enumerate(thresholds)])
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return long.select("threshold", "tn", "fp", "fn", "tp",
                       _div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
                       _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                       _div(tn + tp, tn + fp + fn + tp).alias("accuracy"))


def threshold_report(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """The whole classification report (both classes, accuracy and averages) at each threshold."""
    counts = threshold_sweep(df, label, score, thresholds).select("threshold", "tn", "fp", "fn", "tp")
    return counts.select("threshold", F.explode(_report_rows()).alias("r")).select("threshold", "r.*")


def score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives (partial aggregation)."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))


def running_totals(df: DataFrame, order: Sequence[Column], values: Sequence[str], prefix: str = "cum_",
                   num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of integer ``values`` in ``order``, distributed.

    Rows are range-partitioned and sorted (checkpointed so both passes see the same partitions);
    per-partition sums (at most ``num_partitions`` rows) give each partition's offset, and an
    Arrow-batched ``mapInPandas`` adds the running sum inside the partition.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    sums = ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(
        *[F.sum(v).cast("bigint").alias(f"_s_{v}") for v in values])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                                    for v in values])
    schema = StructType(ranged.schema.fields + [StructField("_pid", LongType())]
                        + [StructField(f"_l_{v}", LongType()) for v in values])
    names = list(values)

    def local_sums(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry = [0] * len(names)
        for pdf in batches:
            for i, v in enumerate(names):
                cs = pdf[v].astype("int64").cumsum() + carry[i]
                pdf[f"_l_{v}"] = cs
                if len(cs):
                    carry[i] = int(cs.iloc[-1])
            pdf["_pid"] = pid
            yield pdf

    local = ranged.mapInPandas(local_sums, schema)
    out = local.join(F.broadcast(offsets.withColumn("_pid", F.col("_pid").cast("bigint"))), "_pid", "inner")
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.col(f"_l_{v}"))
    return out.drop("_pid", *[f"_l_{v}" for v in values], *[f"_o_{v}" for v in values])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC with tied scores sharing their average rank (Mann-Whitney U / (P * N)).

    Scores are grouped first; over the groups in ascending order the negatives below each group
    are a running sum, and ``2U = sum(pos * (2 * neg_below + neg))`` is an exact integer, so the
    result is one division."""
    g = score_groups(df, label, score)
    cum = running_totals(g, [F.col("score").asc()], ["neg"])
    wide = "decimal(18,0)"  # products of two counts pass the range of bigint on very large tables
    return cum.agg(
        F.sum(F.col("pos").cast(wide) * (2 * (F.col("cum_neg") - F.col("neg")) + F.col("neg")).cast(wide)).alias("u2"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    ).select((F.col("u2").cast("double") / (F.lit(2).cast("decimal(1,0)") * F.col("n_pos").cast(wide) * F.col("n_neg").cast(wide)).cast("double")).alias("roc_auc"),
             F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr, tp, fp) for every distinct score in descending order, plus the origin
    (threshold +infinity, 0, 0)."""
    g = score_groups(df, label, score)
    cum = running_totals(g, [F.col("score").desc()], ["pos", "neg"])
    totals = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    p_tot, n_tot = totals.select("P").scalar(), totals.select("N").scalar()
    pts = cum.select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                             F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"))
    allp = pts.unionByName(origin)
    return allp.select("threshold", _div(F.col("fp"), n_tot).alias("fpr"), _div(F.col("tp"), p_tot).alias("tpr"),
                       "tp", "fp")


def score_deciles(df: DataFrame, score: str, key: str, k: int = 10) -> DataFrame:
    """Adds ``rank`` (0 = highest score, ties by key) and ``decile`` (1 = best)."""
    return with_deciles(df, [F.col(score).desc(), F.col(key).asc()], k=k)


def score_table(df: DataFrame, score: str, key: str) -> DataFrame:
    return with_global_position(df, [F.col(score).desc(), F.col(key).asc()], pos_col="rank")


def lift_table(scored: DataFrame, label: str, score: str, key: str, k: int = 10) -> DataFrame:
    """Per decile: customers, actual positives, mean score, positive rate and lift over the
    overall positive rate (a scalar subquery)."""
    d = score_deciles(scored, score, key, k)
    baseline = scored.select(F.avg(F.col(label).cast("double"))).scalar()
    n_pos = F.sum(F.col(label)).cast("bigint")
    n = F.count(F.lit(1))
    agg = d.groupBy("decile").agg(n.alias("customers"), n_pos.alias("actual_positives"),
                                  F.round(F.avg(score), ROUND).alias("avg_predicted_probability"))
    rate = F.col("actual_positives").cast("double") / F.col("customers").cast("double")
    return agg.withColumn("actual_positive_rate", rate).withColumn(
        "lift", F.try_divide(rate, baseline))


def lift_top_pct(scored: DataFrame, label: str, score: str, key: str, pct: float = 20.0) -> DataFrame:
    """Lift of the best ``pct`` percent by rank: positive rate of the first t of q equal-frequency
    buckets, with t/q the exact fraction ``pct``/100 (at whole deciles the same rows as the deciles'),
    divided by the overall rate."""
    part = Fraction(str(pct)) / 100
    d, top = score_deciles(scored, score, key, part.denominator), part.numerator
    baseline = scored.select(F.avg(F.col(label).cast("double"))).scalar()
    sel = d.where(F.col("decile") <= top)
    rate = F.sum(F.col(label)).cast("double") / F.count(F.lit(1)).cast("double")
    return sel.agg(F.lit(float(pct)).alias("top_pct"), F.count(F.lit(1)).alias("customers"),
                   F.sum(F.col(label)).cast("bigint").alias("actual_positives"),
                   rate.alias("actual_positive_rate"), F.try_divide(rate, baseline).alias("lift"))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    return df.agg(F.round(F.avg(score), ROUND).alias("mean_score"), F.max(score).alias("max_score"))


def imbalance_ratio(df: DataFrame, label: str, train_flag: Column | None = None) -> DataFrame:
    """negatives / positives on all rows and, when ``train_flag`` is given, on the training rows."""
    y = F.col(label)
    out = [F.try_divide(F.count_if(y == 0).cast("double"), F.count_if(y == 1).cast("double")).alias("all_rows")]
    if train_flag is not None:
        out.append(F.try_divide(F.count_if((y == 0) & train_flag).cast("double"),
                                F.count_if((y == 1) & train_flag).cast("double")).alias("train_rows"))
    return df.agg(*out)
