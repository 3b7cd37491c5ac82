from datetime import datetime

from firstbasket.operators import clean, encode, profile
from firstbasket.sources.dimensions import fill_unknown, patch_rows


def test_late_flag_boundary_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 0.999), (3, None), (4, 5.0)], "id int, actual_vs_estimated_delivery_days double")
    got = {r["id"]: r["was_late_flag"] for r in clean.add_late_flag(df).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1}


def test_weekday_monday_is_zero_and_month(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 7),)], "first_order_timestamp timestamp_ntz")
    got = [(r["first_order_month"], r["first_order_weekday"]) for r in clean.calendar_features(df).collect()]
    assert got == [(1, 0), (1, 6)]


def test_one_hot_null_gives_zeros_and_keeps_all_levels(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    out = encode.one_hot(df, ["c"])
    assert out.columns == ["id", "c_a", "c_b"]
    rows = {r["id"]: (r["c_a"], r["c_b"]) for r in out.collect()}
    assert rows == {1: (0, 1), 2: (1, 0), 3: (0, 0)}


def test_correlation_constant_column_is_null_not_an_error(spark):
    df = spark.createDataFrame([(1.0, 1, 2.0), (1.0, 0, 1.0), (1.0, 1, 3.0)], "k double, y int, x double")
    got = {r["feature"]: r["corr"] for r in profile.label_correlation(df, "y").collect()}
    assert got["k"] is None and abs(got["x"] - 0.866025) < 1e-6


def test_impute_and_narrow(spark):
    df = spark.createDataFrame([(None, None, None, 3.5)], "first_order_review_score int, review_comment_length int, "
                               "review_response_delay_days double, state_median_monthly_income double")
    out = clean.narrow_types(clean.impute_reviews(df)).first()
    assert out["review_missing_flag"] == 1 and out["first_order_review_score"] == 0
    assert out["state_median_monthly_income"] == 4


def test_quantiles_match_linear_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "v double")
    got = {r["prob"]: r["value"] for r in profile.exact_quantiles(df, ["v"], [0.1, 0.5, 0.99]).collect()}
    assert abs(got[0.1] - 1.4) < 1e-12 and got[0.5] == 3.0 and abs(got[0.99] - 9.76) < 1e-12


def test_describe_categorical_top_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    r = profile.describe_categorical(df, ["c"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (4, 2, "a", 2)


def test_patch_and_fill(spark):
    tr = spark.createDataFrame([("x", "X")], "product_category_name string, product_category_name_english string")
    assert patch_rows(tr, [("y", "Y"), ("x", "X2")], replace=True).count() == 2
    p = spark.createDataFrame([("1", None)], "product_id string, product_category_name string")
    assert fill_unknown(p).first()["product_category_name"] == "unknown_category"


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(2000).selectExpr("cast(id as double) as v")
    exact = {r["prob"]: r["value"] for r in profile.exact_quantiles(df, ["v"], [0.25, 0.5]).collect()}
    approx = {r["prob"]: r["value"] for r in profile.approx_quantiles(df, ["v"], [0.25, 0.5]).collect()}
    assert all(abs(exact[p] - approx[p]) <= 2000 / 10_000 + 1 for p in exact)
