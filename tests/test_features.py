from decimal import Decimal

from conftest import ts
from pyspark.sql import functions as F

from firstbasket.operators import dedup, features

SPINE = "customer_unique_id string, customer_id string, first_order_id string, first_order_timestamp timestamp_ntz"
ITEMS = ("order_id string, order_item_id int, product_id string, seller_id string, "
         "price decimal(12,2), freight_value decimal(12,2)")


def spine(spark, ids):
    return spark.createDataFrame([(f"p{i}", f"c{i}", oid, ts("2020-01-01")) for i, oid in enumerate(ids)], SPINE)


def test_items_counts_sums_and_zero_price_ratio(spark):
    s = spine(spark, ["o1", "o2", "o3"])
    items = spark.createDataFrame([("o1", 1, "a", "s", Decimal("10.00"), Decimal("1.00")),
                                   ("o1", 2, "b", "s", Decimal("30.00"), Decimal("3.00")),
                                   ("o2", 1, "a", "s", Decimal("0.00"), Decimal("5.00"))], ITEMS)
    got = {r["first_order_id"]: r for r in features.item_features(s, items).collect()}
    assert got["o1"]["first_order_item_count"] == 2 and got["o1"]["first_order_price"] == Decimal("40.00")
    assert abs(got["o1"]["freight_price_ratio"] - 0.1) < 1e-12
    assert got["o2"]["freight_price_ratio"] is None
    assert got["o3"]["first_order_item_count"] == 0 and got["o3"]["first_order_price"] is None


def test_payment_mode_tie_takes_smallest_and_all_null_gives_null(spark):
    s = spine(spark, ["o1", "o2", "o3"])
    pay = spark.createDataFrame(
        [("o1", 1, "voucher", 1), ("o1", 2, "boleto", 3), ("o1", 3, "voucher", 2), ("o1", 4, "boleto", 1),
         ("o2", 1, None, 1)], "order_id string, payment_sequential int, payment_type string, payment_installments int")
    got = {r["first_order_id"]: r for r in features.payment_features(s, pay).collect()}
    assert got["o1"]["primary_payment_type"] == "boleto"
    assert got["o1"]["used_multiple_payment_types"] == 1
    assert got["o1"]["count_payment_installments"] == 3 and got["o1"]["count_payment_sequential"] == 4
    assert got["o2"]["primary_payment_type"] is None and got["o2"]["used_multiple_payment_types"] == 0
    assert got["o3"]["used_multiple_payment_types"] == 0


def test_dominant_category_skips_untranslated_and_ranks_null_price_first(spark):
    s = spine(spark, ["o1", "o2", "o3"])
    items = spark.createDataFrame([("o1", 1, "cheap", "s", Decimal("5.00"), None),
                                   ("o1", 2, "dear_untranslated", "s", Decimal("99.00"), None),
                                   ("o2", 1, "cheap", "s", Decimal("50.00"), None),
                                   ("o2", 2, "unpriced", "s", None, None),
                                   ("o3", 1, "dear_untranslated", "s", Decimal("1.00"), None)], ITEMS)
    products = spark.createDataFrame([("cheap", "cat_a"), ("dear_untranslated", "cat_x"), ("unpriced", "cat_b")],
                                     "product_id string, product_category_name string")
    tr = spark.createDataFrame([("cat_a", "A"), ("cat_b", "B")],
                               "product_category_name string, product_category_name_english string")
    got = {r["first_order_id"]: r["first_order_category"]
           for r in features.dominant_category(s, items, products, tr).collect()}
    assert got == {"o1": "A", "o2": "B"}


def test_review_features_flags_and_delay(spark):
    s = spine(spark, ["o1", "o2", "o3"])
    rev = spark.createDataFrame([("o1", "r1", 5, "héllo", ts("2020-01-02"), ts("2020-01-03 12:00:00")),
                                 ("o2", "r2", 3, None, ts("2020-01-02"), None)],
                                "order_id string, review_id string, review_score int, review_comment_message string, "
                                "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
    got = {r["first_order_id"]: r for r in features.review_features(s, rev).collect()}
    assert got["o1"]["review_comment_flag"] == 1 and got["o1"]["review_comment_length"] == 5
    assert got["o1"]["review_response_delay_days"] == 1.5
    assert got["o2"]["review_comment_flag"] == 0 and got["o2"]["review_comment_length"] is None
    assert got["o3"]["review_comment_flag"] == 0 and got["o3"]["first_order_review_score"] is None


def test_keep_latest_prefers_missing_answer_time_then_latest_then_highest_id(spark):
    raw = spark.createDataFrame([("r1", "o1", ts("2020-01-05")), ("r2", "o1", None), ("r3", "o1", ts("2020-01-09")),
                                 ("r4", "o2", ts("2020-01-05")), ("r5", "o2", ts("2020-01-05")),
                                 ("r6", "o3", ts("2020-01-01"))],
                                "review_id string, order_id string, review_answer_timestamp timestamp_ntz")
    got = {r["order_id"]: r["review_id"] for r in dedup.keep_latest(raw).collect()}
    assert got == {"o1": "r2", "o2": "r5", "o3": "r6"}
    assert dedup.keep_latest(raw).columns[0] == "order_id"
    dup = dedup.duplicate_rows(raw)
    assert sorted(r["review_id"] for r in dup.collect()) == ["r1", "r2", "r3", "r4", "r5"]
    top = dedup.duplicate_key_counts(raw, k=1).collect()
    assert [(r["order_id"], r["n"]) for r in top] == [("o1", 3)]


def test_min_by_struct_is_partition_invariant(spark):
    s = spine(spark, [f"o{i}" for i in range(40)])
    rows = [(f"o{i}", j, f"p{j}", "s", Decimal(str((i * 7 + j * 3) % 11)), None) for i in range(40) for j in range(5)]
    items = spark.createDataFrame(rows, ITEMS)
    products = spark.createDataFrame([(f"p{j}", f"c{j}") for j in range(5)], "product_id string, product_category_name string")
    tr = spark.createDataFrame([(f"c{j}", f"E{j}") for j in range(5)],
                               "product_category_name string, product_category_name_english string")
    base = sorted(features.dominant_category(s, items, products, tr).collect())
    for n in (1, 4, 17):
        again = sorted(features.dominant_category(s, items.repartition(n), products, tr).collect())
        assert again == base
    assert F is not None
