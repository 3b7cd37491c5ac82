"""Profiling operators against pandas / numpy brute force on random data with NULLs."""

import random

import numpy as np
import pandas as pd

from firstbasket.operators import profile


def _frame(spark, n=700, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = None if rnd.random() < 0.1 else round(rnd.gauss(50, 20), 3)
        b = None if rnd.random() < 0.2 else rnd.randint(0, 9)
        c = None if rnd.random() < 0.15 else rnd.choice(["x", "y", "z", "w"])
        rows.append((i, a, b, c))
    return spark.createDataFrame(rows, "id long, a double, b int, c string"), pd.DataFrame(rows, columns=["id", "a", "b", "c"])


def test_describe_numeric_matches_pandas(spark):
    sdf, pdf = _frame(spark)
    got = {r["column_name"]: r for r in profile.describe_numeric(sdf, ["a", "b"]).collect()}
    for c in ("a", "b"):
        s = pdf[c].dropna().astype(float)
        r = got[c]
        assert r["count"] == len(s)
        assert abs(r["mean"] - round(s.mean(), 6)) < 1e-6 and abs(r["std"] - round(s.std(), 6)) < 1e-6
        assert r["min"] == s.min() and r["max"] == s.max()
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert abs(r[name] - np.quantile(s.values, p)) < 1e-6


def test_counts_and_shares_match_pandas(spark):
    sdf, pdf = _frame(spark)
    nulls = {r["column_name"]: r["null_rows"] for r in profile.null_counts(sdf).collect()}
    assert nulls == {c: int(pdf[c].isna().sum()) for c in pdf.columns}
    distinct = {r["column_name"]: r["n_distinct"] for r in profile.distinct_counts(sdf).collect()}
    assert distinct == {c: int(pdf[c].nunique()) for c in pdf.columns}
    shares = {r["c"]: r["share"] for r in profile.value_shares(sdf, "c").collect()}
    expect = pdf["c"].value_counts(normalize=True).to_dict()
    assert set(shares) == set(expect) and all(abs(shares[k] - expect[k]) < 1e-12 for k in expect)
    counts = [(r["c"], r["n"]) for r in profile.value_counts(sdf, "c").collect()]
    assert [n for _, n in counts] == sorted((n for _, n in counts), reverse=True)


def test_histogram_matches_numpy(spark):
    sdf, pdf = _frame(spark)
    got = sorted((r["bin"], r["n"]) for r in profile.histogram(sdf, ["a"], bins=10).collect())
    counts, _ = np.histogram(pdf["a"].dropna().values, bins=10)
    assert [n for _, n in got] == counts.tolist()


def test_correlation_matches_pandas_pairwise(spark):
    sdf, pdf = _frame(spark)
    got = {r["feature"]: r["corr"] for r in profile.label_correlation(sdf, "b", ["a", "id"]).collect()}
    for c in ("a", "id"):
        assert abs(got[c] - round(pdf[c].astype(float).corr(pdf["b"].astype(float)), 6)) < 1e-6


def test_approx_distinct_counts_close(spark):
    sdf, pdf = _frame(spark)
    got = {r["column_name"]: r["n_distinct"] for r in profile.distinct_counts(sdf, ["id", "c"], approx=True).collect()}
    assert abs(got["id"] - 700) <= 35 and got["c"] == 4
