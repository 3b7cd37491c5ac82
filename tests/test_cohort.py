from datetime import datetime, timedelta

from conftest import ts
from pyspark.sql import functions as F

from firstbasket.config import Config
from firstbasket.operators import cohort

CFG = Config(dataset_end=datetime(2020, 12, 31), horizon_days=180)
ORD = ("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
CUS = "customer_id string, customer_unique_id string, customer_state string"


def _frames(spark, orders, customers):
    return spark.createDataFrame(orders, ORD), spark.createDataFrame(customers, CUS)


def _label(spark, orders, customers):
    o, c = _frames(spark, orders, customers)
    d = cohort.delivered_orders(o, c, CFG)
    spine = cohort.first_order_spine(d, CFG)
    return {r["customer_unique_id"]: r for r in cohort.reorder_label(spine, d, CFG).collect()}


def o(oid, cid, t, status="delivered", delivered="2020-06-01", est="2020-06-01"):
    return (oid, cid, status, ts(t) if t else None, ts(delivered) if delivered else None, ts(est))


def test_horizon_bounds_inclusive_and_strict(spark):
    t0 = "2020-01-01 00:00:00"
    at_180 = (ts(t0) + timedelta(days=180)).isoformat(sep=" ")
    after_180 = (ts(t0) + timedelta(days=180, microseconds=1)).isoformat(sep=" ")
    orders = [o("a1", "A", t0), o("a2", "A", at_180),
              o("b1", "B", t0), o("b2", "B", after_180)]
    lab = _label(spark, orders, [("A", "pA", "S1"), ("B", "pB", "S1")])
    assert lab["pA"]["reordered_180d"] == 1
    assert lab["pB"]["reordered_180d"] == 0


def test_same_instant_second_order_is_not_a_reorder_and_tie_breaks_by_id(spark):
    t0 = "2020-01-01 10:00:00"
    lab = _label(spark, [o("x2", "A", t0), o("x1", "A", t0)], [("A", "pA", "S1")])
    assert lab["pA"]["first_order_id"] == "x1"
    assert lab["pA"]["reordered_180d"] == 0


def test_undelivered_and_late_delivered_orders_are_ignored(spark):
    orders = [o("a1", "A", "2020-01-01"), o("a2", "A", "2020-02-01", status="shipped"),
              o("a3", "A", "2020-02-02", delivered="2021-02-01"),
              o("b0", "B", "2019-12-01", delivered=None), o("b1", "B", "2020-01-05")]
    lab = _label(spark, orders, [("A", "pA", "S1"), ("B", "pB", "S1")])
    assert lab["pA"]["reordered_180d"] == 0
    assert lab["pB"]["first_order_id"] == "b1"


def test_first_order_after_cutoff_excluded_and_null_time_never_first(spark):
    cutoff = CFG.first_order_cutoff
    late = (cutoff + timedelta(seconds=1)).isoformat(sep=" ")
    orders = [o("a1", "A", late), o("c0", "C", None), o("c1", "C", "2020-01-01")]
    lab = _label(spark, orders, [("A", "pA", "S1"), ("C", "pC", "S1")])
    assert "pA" not in lab
    assert lab["pC"]["first_order_id"] == "c1"


def test_two_customer_ids_for_one_person_take_state_of_first_order(spark):
    orders = [o("a1", "A1", "2020-01-01"), o("a2", "A2", "2020-03-01")]
    lab = _label(spark, orders, [("A1", "p", "SP"), ("A2", "p", "RJ")])
    assert lab["p"]["customer_state"] == "SP"
    assert lab["p"]["customer_id"] == "A1"
    assert lab["p"]["reordered_180d"] == 1


def test_reorder_events_flags_each_order(spark):
    o_df, c_df = _frames(spark, [o("a1", "A", "2020-01-01"), o("a2", "A", "2020-02-01"),
                                 o("a3", "A", "2020-12-01")], [("A", "pA", "S1")])
    d = cohort.delivered_orders(o_df, c_df, CFG)
    ev = cohort.reorder_events(cohort.first_order_spine(d, CFG), d, CFG)
    flags = {r["order_id"]: r["reordered_180d"] for r in ev.collect()}
    assert flags == {"a1": 0, "a2": 1, "a3": 0}


def test_filters_reach_the_scan(spark, tmp_path):
    o_df, _ = _frames(spark, [o("a1", "A", "2020-01-01")], [("A", "pA", "S1")])
    path = str(tmp_path / "orders")
    o_df.write.parquet(path)
    plan = spark.read.parquet(path).where((F.col("order_status") == "delivered")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "order_status" in plan
