import math
import random

import pytest
from pyspark.sql import functions as F

from firstbasket.operators import metrics, profile, rank, split


def decile_reference(i: int, n: int) -> int:
    return 1 if n <= 1 else max(1, math.ceil(10 * i / (n - 1)))


@pytest.mark.parametrize("n", [1, 10, 11, 25, 91])
def test_deciles_closed_form_and_sizes(spark, n):
    df = spark.createDataFrame([(i, float(n - i)) for i in range(n)], "id long, score double")
    got = {r["id"]: (r["rank"], r["decile"]) for r in metrics.score_deciles(df, "score", "id").collect()}
    for i in range(n):
        assert got[i] == (i, decile_reference(i, n))
    if n >= 10:
        sizes = [sum(1 for v in got.values() if v[1] == d) for d in range(1, 11)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 2


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_global_position_equals_row_number(spark, parts):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 5), rnd.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g int, v double").repartition(parts)
    got = {r["id"]: r["pos"] for r in rank.with_global_position(df, ["g", "v", "id"], num_partitions=parts).collect()}
    expect = {row[0]: i for i, row in enumerate(sorted(rows, key=lambda r: (r[1], r[2], r[0])))}
    assert got == expect
    seg = {r["id"]: r["row_number"] for r in rank.segment_row_number(df, ["g"], ["v", "id"]).collect()}
    for g in range(6):
        members = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        assert [seg[r[0]] for r in members] == list(range(1, len(members) + 1))


def test_hot_key_is_split_across_range_partitions(spark):
    rows = [(i, 0 if i % 3 else 1, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    seg = rank.segment_row_number(df, ["g"], ["v", "id"], num_partitions=8)
    assert seg.where("g = 0").agg(F.max("row_number")).first()[0] == 2000


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_segments_over_many_partitions_nulls_and_nans(spark, parts):
    rnd = random.Random(parts)
    rows = [(i, None if i % 11 == 0 else 2.5 if i % 3 == 0 else float("nan") if i % 7 == 0 else float(rnd.randint(0, 400)),
             rnd.choice([None, "a", "b"])) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, g double, h string").repartition(7)
    seg = rank.segment_row_number(df, ["g", "h"], [F.col("id").desc()], num_partitions=parts, size_col="n")
    plan = seg._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and "(_pid" in plan  # on the partition, and on the few sizes
    got = {r["id"]: (r["row_number"], r["n"]) for r in seg.collect()}
    groups = {}
    for i, g, h in sorted(rows, key=lambda r: -r[0]):
        groups.setdefault((str(g), h), []).append(i)
    assert got == {i: (k + 1, len(ids)) for ids in groups.values() for k, i in enumerate(ids)}


def test_segment_row_number_of_no_rows(spark):
    df = spark.createDataFrame([], "id long, g int")
    assert rank.segment_row_number(df, ["g"], ["id"], size_col="n").collect() == []


def test_quantiles_of_columns_with_few_values(spark):
    import numpy as np
    rnd = random.Random(5)
    rows = [(float(i % 3 == 0), rnd.choice([-0.0, 0.0, 1.5]), None if i % 5 else float(i), rnd.gauss(0, 1)) for i in range(999)]
    df = spark.createDataFrame(rows, "flag double, few double, gaps double, spread double").repartition(9)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["column_name"], r["prob"]): r["value"] for r in profile.exact_quantiles(df, df.columns, probs).collect()}
    for at, c in enumerate(df.columns):
        want = np.quantile([r[at] for r in rows if r[at] is not None], probs)
        assert [got[c, p] for p in probs] == pytest.approx(list(want), rel=1e-12, abs=1e-12)
    assert len(got) == len(probs) * 4


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def test_auc_with_ties_matches_pairwise_count(spark):
    rnd = random.Random(3)
    pairs = [(1 if rnd.random() < 0.3 else 0, round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "y int, s double")
    auc = metrics.roc_auc(df, "y", "s").first()["roc_auc"]
    assert abs(auc - brute_auc(pairs)) < 1e-12


def test_roc_curve_points_and_origin(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    pts = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "s").collect())
    assert pts == [(0.1, 1.0, 1.0), (0.5, 0.5, 1.0), (0.9, 0.5, 0.5), (float("inf"), 0.0, 0.0)]


def test_sweep_counts_score_equal_to_threshold_as_positive_and_zero_division(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2), (0, 0.1)], "y int, s double")
    rows = {r["threshold"]: r for r in metrics.threshold_sweep(df, "y", "s", [0.5, 0.9]).collect()}
    assert (rows[0.5]["tp"], rows[0.5]["fp"], rows[0.5]["fn"], rows[0.5]["tn"]) == (1, 0, 0, 2)
    assert rows[0.9]["tp"] == 0 and rows[0.9]["precision"] == 0.0 and rows[0.9]["f1"] == 0.0
    recalls = [rows[t]["recall"] for t in sorted(rows)]
    assert recalls == sorted(recalls, reverse=True)


def test_classification_report_matches_definitions(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 0.5 and rep["1"]["support"] == 2
    assert abs(rep["0"]["precision"] - 2 / 3) < 1e-12 and abs(rep["0"]["recall"] - 2 / 3) < 1e-12
    assert rep["accuracy"]["f1"] == 0.6 and rep["accuracy"]["support"] == 5


def test_lift_weighted_mean_is_one(spark):
    rnd = random.Random(11)
    rows = [(i, 1 if rnd.random() < 0.2 else 0, rnd.random()) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int, s double")
    lift = metrics.lift_table(df, "y", "s", "id").collect()
    n = sum(r["customers"] for r in lift)
    assert n == 1000
    assert abs(sum(r["lift"] * r["customers"] for r in lift) / n - 1.0) < 1e-9


def test_histogram_max_in_last_bin_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (1.0,)], "x double")
    h = {r["bin"]: r["n"] for r in profile.histogram(df, ["x"], bins=10).collect()}
    assert h[1] == 2 and h[10] == 1 and len(h) == 10 and sum(h.values()) == 3


def test_stratified_split_and_folds(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(503)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = split.stratified_split(df, "y", "id", 0.2, 42)
    per = {r["y"]: (r["n"], r["t"]) for r in s.groupBy("y").agg(F.count("*").alias("n"),
                                                                 F.sum("is_test").alias("t")).collect()}
    for n, t in per.values():
        assert t == math.ceil(0.2 * n)
    again = sorted(split.stratified_split(df.repartition(5), "y", "id", 0.2, 42).collect())
    assert sorted(s.collect()) == again
    f = split.stratified_folds(df, "y", "id", 3, 42)
    sizes = {}
    for r in f.groupBy("y", "fold").agg(F.count("*").alias("c")).collect():
        sizes.setdefault(r["y"], []).append(r["c"])
    assert all(len(v) == 3 and max(v) - min(v) <= 1 for v in sizes.values())


def test_every_threshold_has_the_whole_report(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.6), (0, 0.1), (0, 0.3)], "y int, s double")
    got = metrics.threshold_report(df, "y", "s", [0.5, 0.15]).collect()
    assert len(got) == 10
    for t in (0.5, 0.15):
        one = metrics.classification_report(df.selectExpr("y", f"int(s >= {t}) AS p"), "y", "p").collect()
        assert [tuple(r)[1:] for r in got if r.threshold == t] == [tuple(r) for r in one]
