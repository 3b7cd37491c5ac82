"""Plan-shape checks for the properties the design relies on at scale."""

from datetime import datetime

from pyspark.sql import functions as F

from firstbasket.config import Config
from firstbasket.operators import cohort, features, profile

CFG = Config(dataset_end=datetime(2020, 12, 31))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _orders(spark, tmp_path):
    rows = [(f"o{i}", f"c{i % 7}", "delivered" if i % 3 else "shipped", datetime(2020, 1, 1 + i % 20),
             datetime(2020, 2, 1), datetime(2020, 2, 3)) for i in range(60)]
    o = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                    "order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
                                    "order_estimated_delivery_date timestamp_ntz")
    c = spark.createDataFrame([(f"c{i}", f"p{i % 5}", "S") for i in range(7)],
                              "customer_id string, customer_unique_id string, customer_state string")
    o.write.parquet(str(tmp_path / "orders"))
    c.write.parquet(str(tmp_path / "customers"))
    return spark.read.parquet(str(tmp_path / "orders")), spark.read.parquet(str(tmp_path / "customers"))


def test_spine_and_label_use_aggregates_not_windows_and_push_filters(spark, tmp_path):
    o, c = _orders(spark, tmp_path)
    d = cohort.delivered_orders(o, c, CFG)
    lab = cohort.reorder_label(cohort.first_order_spine(d, CFG), d, CFG)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(lab)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Window" not in plan
    assert "EqualTo(order_status,delivered)" in plan
    assert "LessThanOrEqual(order_delivered_customer_date,2020-12-31T00:00)" in plan


def test_product_lookup_is_broadcast_when_small(spark):
    items = spark.createDataFrame([("o1", 1, "p1", "s1", None, None)],
                                  "order_id string, order_item_id int, product_id string, seller_id string, "
                                  "price decimal(12,2), freight_value decimal(12,2)")
    products = spark.createDataFrame([("p1", "c")], "product_id string, product_category_name string")
    tr = spark.createDataFrame([("c", "C")], "product_category_name string, product_category_name_english string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(features.order_baskets(items, products, tr))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "hashpartitioning(product_id" not in plan


def test_correlation_is_one_narrow_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("y"), *[(F.col("id") * i).alias(f"x{i}") for i in range(40)])
    plan = plan_of(profile.label_correlation(df, "y"))
    assert plan.count("HashAggregate") + plan.count("SortAggregate") + plan.count("ObjectHashAggregate") <= 2
    assert "Window" not in plan
