"""Correctness when one key holds a third of all rows (hot person, hot order)."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from firstbasket.config import Config
from firstbasket.operators import cohort, dedup

CFG = Config(dataset_end=datetime(2021, 12, 31), horizon_days=180)
ORD = ("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")


@pytest.mark.parametrize("hot_rows", [1_000_000, 500])
def test_hot_person_spine_and_label(spark, hot_rows):
    base = datetime(2020, 1, 1)
    rows = []
    for i in range(3000):  # a third of all orders belong to person "hot", spread over two years
        rows.append((f"h{i:05d}", "H", "delivered", base + timedelta(hours=5 * i), base + timedelta(days=700),
                     base + timedelta(days=700)))
    for p in range(2000):  # the rest: two orders each, the second 200 or 100 days later
        gap = 200 if p % 2 else 100
        for k in range(3):
            rows.append((f"o{p:05d}_{k}", f"C{p}", "delivered", base + timedelta(days=p % 300 + k * gap),
                         base + timedelta(days=400), base + timedelta(days=400)))
    orders = spark.createDataFrame(rows, ORD).repartition(16)
    customers = spark.createDataFrame([("H", "hot", "S")] + [(f"C{p}", f"p{p}", "S") for p in range(2000)],
                                      "customer_id string, customer_unique_id string, customer_state string")
    cfg = Config(dataset_end=CFG.dataset_end, horizon_days=180, hot_key_rows=hot_rows)
    d = cohort.delivered_orders(orders, customers, cfg)
    spine = cohort.first_order_spine(d, cfg)
    lab = {r["customer_unique_id"]: r for r in cohort.reorder_label(spine, d, cfg).collect()}
    events = cohort.reorder_events(spine, d, cfg)
    assert events.count() == d.count()  # every order of every spine person exactly once, salted or not
    assert events.where("customer_unique_id = 'hot'").agg({"reordered_180d": "sum"}).first()[0] > 0
    assert lab["hot"]["first_order_id"] == "h00000" and lab["hot"]["reordered_180d"] == 1
    assert all(lab[f"p{p}"]["reordered_180d"] == (0 if p % 2 else 1) for p in range(2000))


def test_hot_orders_after_the_cutoff_are_split(spark):
    start, end = datetime(2021, 1, 1), datetime(2021, 12, 31)
    cfg = Config(dataset_end=end, horizon_days=180, hot_key_rows=100)
    rows = [("h0", "H", "delivered", start, start, start)]
    rows += [(f"h{i}", "H", "delivered", datetime(2021, 9, 1) + timedelta(minutes=i), end, end) for i in range(1, 3001)]
    rows += [(f"o{i}", f"C{i % 3000}", "delivered", start + timedelta(days=i % 150), end, end) for i in range(6000)]
    orders = spark.createDataFrame(rows, ORD).repartition(16)
    customers = spark.createDataFrame([("H", "hot", "S")] + [(f"C{p}", f"p{p}", "S") for p in range(3000)],
                                      "customer_id string, customer_unique_id string, customer_state string")
    d = cohort.delivered_orders(orders, customers, cfg)
    spine = cohort.first_order_spine(d, cfg)
    salted = cohort._salted_join(d, spine, cfg)
    sizes = salted.groupBy("s_person", "s_salt").count()
    assert salted.count() == 9001 and sizes.agg(F.max("count")).first()[0] < 200  # 3,001 orders over 31 salts
    hot = cohort.reorder_label(spine, d, cfg).where("customer_unique_id = 'hot'").first()
    assert hot["first_order_id"] == "h0" and hot["reordered_180d"] == 0


@pytest.mark.parametrize("days", [1, 7, 180])
def test_label_from_bucket_extremes_equals_every_pair(spark, days):
    rnd = random.Random(days)
    base, end = datetime(1969, 6, 1), datetime(1971, 6, 1)  # on both sides of the epoch
    cfg = Config(dataset_end=end, horizon_days=days)
    rows, latest = [], cfg.first_order_cutoff
    for i in range(1500):
        t = base + timedelta(hours=rnd.randrange(24 * 730)) if rnd.random() < 0.97 else None
        rows.append((f"o{i:04d}", f"C{rnd.randrange(400)}", "delivered", t, base, base))
    for c in range(20):  # at the bounds: no later, a microsecond within, at the end, past it
        t0 = base + timedelta(days=c)
        for k, gap in enumerate((timedelta(0), timedelta(days=days) + timedelta(microseconds=c % 3 - 1))):
            rows.append((f"e{c}_{k}", f"E{c}", "delivered", t0 + gap, base, base))
    orders = spark.createDataFrame(rows, ORD)
    customers = orders.select("customer_id", F.col("customer_id").alias("customer_unique_id"), F.lit("S").alias("customer_state")).distinct()
    d = cohort.delivered_orders(orders, customers, cfg)
    got = {r["customer_unique_id"]: r["reordered_180d"]
           for r in cohort.reorder_label(cohort.first_order_spine(d, cfg), d, cfg).collect()}
    want = {}
    for person in {r[1] for r in rows}:
        mine = sorted((r[3], r[0]) for r in rows if r[1] == person and r[3] is not None)
        if mine and mine[0][0] <= latest:
            t0, first = mine[0]
            want[person] = int(any(t0 < t <= t0 + timedelta(days=days) and i != first for t, i in mine))
    assert got == want and 0 < sum(got.values()) < len(got)


def test_hot_order_review_dedup(spark):
    rows = [(f"r{i:05d}", "hot", datetime(2020, 1, 1) + timedelta(minutes=i)) for i in range(3000)]
    rows += [(f"x{i:05d}", f"o{i % 3000}", datetime(2020, 1, 1)) for i in range(6000)]
    raw = spark.createDataFrame(rows, "review_id string, order_id string, review_answer_timestamp timestamp_ntz")
    kept = {r["order_id"]: r["review_id"] for r in dedup.keep_latest(raw.repartition(16)).collect()}
    assert kept["hot"] == "r02999" and len(kept) == 3001
