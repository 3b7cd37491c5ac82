"""Customer cohort: delivered orders, each person's first delivered order (the spine) and the
repeat-purchase label.

Design (scale): the first order is an aggregate (``min`` over a struct ordered by purchase time
then order id) instead of a ``row_number`` window, so it gets map-side partial aggregation and a
person holding a third of all orders never lands in one task. For the label, orders are reduced to
their earliest and latest purchase per (person, time bucket) before they meet the spine, again by a
partial aggregate; the bucket is as long as the horizon, so a person meets at most two of them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import flag, ts_literal

PERSON = "customer_unique_id"
PURCHASE = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"


def horizon(cfg: Config):
    return F.expr(f"INTERVAL {int(cfg.horizon_days)} DAYS")


def dataset_bounds(orders: DataFrame, cfg: Config) -> DataFrame:
    """One row: the configured end and cut-off, plus the observed purchase range and how many
    delivered orders fall after the end (these are ignored by every later step)."""
    return orders.agg(
        ts_literal(cfg.dataset_end).alias("dataset_end"),
        ts_literal(cfg.first_order_cutoff).alias("first_order_cutoff_date"),
        F.min(PURCHASE).alias("first_purchase_seen"),
        F.max(PURCHASE).alias("last_purchase_seen"),
        F.count_if((F.col("order_status") == cfg.delivered_status)
                   & (F.col(DELIVERED) > ts_literal(cfg.dataset_end))).cast("bigint")
        .alias("delivered_after_end"),
    )


def delivered_orders(orders: DataFrame, customers: DataFrame, cfg: Config) -> DataFrame:
    """Orders delivered on or before the dataset end, with the person and state of their customer.

    Both filters reach the order scan (pushed down); NULL delivery dates fall out.
    """
    o = orders.where((F.col("order_status") == F.lit(cfg.delivered_status))
                     & (F.col(DELIVERED) <= ts_literal(cfg.dataset_end)))
    c = customers.select("customer_id", PERSON, "customer_state")
    return (o.join(c, "customer_id", "inner")
            .select(PERSON, "customer_id", "customer_state", "order_id", PURCHASE, DELIVERED, ESTIMATED))


def first_order_spine(delivered: DataFrame, cfg: Config) -> DataFrame:
    """One row per person: the earliest delivered order (ties broken by order id), kept only when it
    was placed on or before the cut-off so that a full horizon follows it.

    Orders without a purchase time never rank first (NULLS LAST). The cut-off is applied before
    the minimum: when a person's earliest purchase is on or before the cut-off it is also the
    earliest among their purchases on or before it, and persons without such a purchase are
    excluded either way. So later orders are never shuffled for the spine, and the bound reaches
    the scan as a pushed filter.
    """
    first = F.min(F.struct(F.col(PURCHASE), F.col("order_id"), F.col("customer_id"),
                           F.col("customer_state"), F.col(DELIVERED), F.col(ESTIMATED)))
    return (delivered.where(F.col(PURCHASE).isNotNull()
                            & (F.col(PURCHASE) <= ts_literal(cfg.first_order_cutoff)))
            .groupBy(PERSON).agg(first.alias("f"))
            .select(PERSON,
                    F.col("f.customer_id").alias("customer_id"),
                    F.col("f.order_id").alias("first_order_id"),
                    F.col(f"f.{PURCHASE}").alias("first_order_timestamp"),
                    F.col("f.customer_state").alias("customer_state"),
                    F.col(f"f.{DELIVERED}").alias(DELIVERED),
                    F.col(f"f.{ESTIMATED}").alias(ESTIMATED)))


def _salted_join(orders: DataFrame, spine: DataFrame, cfg: Config) -> DataFrame:
    """Orders joined to their person's spine row, with hot persons salted.

    A person with more than ``cfg.hot_key_rows`` of the orders that the join reads gets ``salt_n =
    ceil(orders / hot_key_rows)`` salts: their orders are spread by a hash of the order id, and their
    spine row is replicated once per salt, so the join on (person, salt) runs in ``salt_n`` tasks and
    every order still meets its spine row exactly once. There are at most ``orders / hot_key_rows`` hot
    persons, which bounds the broadcast of the hot list. (AQE's skew join cannot split this join by
    itself: the spine side is an aggregate's output, not a plain shuffle stage.)
    """
    hot = (orders.groupBy(F.col(PERSON).alias("hot_person")).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > int(cfg.hot_key_rows))
           .select("hot_person", F.ceil(F.col("n") / F.lit(int(cfg.hot_key_rows))).cast("int").alias("salt_n")))
    salts = F.coalesce("salt_n", F.lit(1))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), F.col(PERSON) == F.col("hot_person"), "left")

    o = with_salts(orders).select(
        F.col(PERSON).alias("o_person"), F.col("order_id").alias("o_order_id"), F.col(PURCHASE).alias("o_ts"),
        F.pmod(F.xxhash64("order_id"), salts).cast("int").alias("o_salt"))
    s = with_salts(spine).select(
        F.col(PERSON).alias("s_person"), "first_order_id", "first_order_timestamp",
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("s_salt"))
    return o.join(s, (F.col("o_person") == F.col("s_person")) & (F.col("o_salt") == F.col("s_salt")), "inner")


def _pair_is_reorder(cfg: Config):
    return ((F.col("o_ts") > F.col("first_order_timestamp"))
            & (F.col("o_ts") <= F.col("first_order_timestamp") + horizon(cfg))
            & (F.col("o_order_id") != F.col("first_order_id")))


def reorder_events(spine: DataFrame, delivered: DataFrame, cfg: Config) -> DataFrame:
    """Every delivered order of every spine person, flagged 1 when it is a repeat purchase inside
    the horizon."""
    pairs = _salted_join(delivered, spine, cfg)
    return pairs.select(F.col("s_person").alias(PERSON), "first_order_id", "first_order_timestamp",
                        F.col("o_order_id").alias("order_id"), flag(_pair_is_reorder(cfg)).alias("reordered_180d"))


def _bucket(ts: str, cfg: Config):
    """Number of the calendar span, as long as the horizon, that ``ts`` lies in."""
    return F.floor(F.unix_date(F.to_date(ts)) / F.lit(int(cfg.horizon_days)))


def reorder_label(spine: DataFrame, delivered: DataFrame, cfg: Config) -> DataFrame:
    """The spine plus ``reordered_180d`` (1 if any repeat purchase falls inside the horizon).

    A horizon that begins in a bucket ends in the next one. It holds all later purchases of its own
    bucket, so one exists if the bucket's latest is later; and it holds one of the next bucket if
    that one's earliest is not past its end. The two extremes of each (person, bucket) therefore settle
    the label, and they come from a partial aggregate: orders of a hot person are reduced in the map
    tasks wherever they lie in time, and both sides of the join hold a key once. A purchase later than
    the first order is another order, as order ids are unique.
    """
    if cfg.horizon_days < 1:
        raise ValueError("the horizon is a whole number of days, one or more")
    # A repeat purchase falls at most the horizon after a first order that is itself on or before
    # the cut-off, so later purchases cannot match (a pushed filter on the scan).
    latest = ts_literal(cfg.first_order_cutoff + timedelta(days=int(cfg.horizon_days)))
    seen = (delivered.where(F.col(PURCHASE) <= latest)
            .groupBy(F.col(PERSON).alias("o_person"), _bucket(PURCHASE, cfg).alias("o_bucket"))
            .agg(F.min(PURCHASE).alias("earliest"), F.max(PURCHASE).alias("latest")))
    own = _bucket("first_order_timestamp", cfg)
    reach = spine.select(F.col(PERSON).alias("s_person"), "first_order_timestamp",
                         F.explode(F.array(own, own + 1)).alias("s_bucket"))
    inside = ((F.col("latest") > F.col("first_order_timestamp"))
              & (F.col("earliest") <= F.col("first_order_timestamp") + horizon(cfg)))
    hits = (reach.join(seen, (F.col("s_person") == F.col("o_person")) & (F.col("s_bucket") == F.col("o_bucket")) & inside)
            .groupBy(F.col("s_person").alias(PERSON)).agg(F.lit(1).alias("reordered_180d")))
    return (spine.join(hits, PERSON, "left")
            .withColumn("reordered_180d", F.coalesce(F.col("reordered_180d"), F.lit(0)).cast("int")))
