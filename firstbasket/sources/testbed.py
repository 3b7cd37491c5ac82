"""Role mapping of the synthetic star-schema tables onto the ten source roles.

The driver's test data is a TPC-H-like schema plus an event stream; this
module derives each role the operators expect with plain DataFrame
transformations, so every query's work grows with the given tables.
Ids keep their native bigint type (cheaper to shuffle and join than text).

Mapping (fixed for all queries):
  customers        customer left join nation; person id = customer id; state = nation name
  orders           orders left join (latest ship date per order); F/O/P -> delivered/shipped/canceled;
                   delivered = latest ship date; estimated = order date + 30 days
  order_items      lineitem; price = extended price as money; freight = price * tax
  order_payments   lineitem; type = return flag; sequential = line number; installments = quantity
  products         part; category = part type
  translation      distinct part types but the held-back ones, lower-cased (the patch adds one back)
  order_reviews    events; order = event id div 2; score by event type; message = props
  state income     mean supplier account balance per nation, 2 decimals
  sellers          supplier left join nation
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the mapping.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "canceled"}
SCORE_BY_EVENT = {"error": 1, "view": 2, "click": 3, "signup": 4, "purchase": 5}
EVENTS_WITHOUT_MESSAGE = ("view", "signup")
ESTIMATED_DELIVERY_DAYS = 30
# Part types left out of the base translation table; the patch rows restore the first one,
# so items of the second stay untranslated and drop out of the dominant-category ranking.
UNTRANSLATED_TYPES = ("PROMO", "SMALL")
TRANSLATION_PATCH = (("PROMO", "promo"), ("unknown_category", "unknown_category"))


# Declared layouts of the test tables (the same at every scale). Reading with a given schema
# skips the footer-inference job Spark otherwise runs for every ``read.parquet`` call.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(column: str, mapping: dict, default=None):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(F.col(column) == F.lit(key), F.lit(value)) if expr is None
                else expr.when(F.col(column) == F.lit(key), F.lit(value)))
    return expr.otherwise(F.lit(default))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_custkey").alias("customer_unique_id"),
                    F.lit(None).cast("string").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    shipped = (table(spark, sf_dir, "lineitem")
               .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship")))
    return (o.join(shipped, o.o_orderkey == shipped.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    _case("o_orderstatus", STATUS_BY_CODE, "unavailable").alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"),
                    F.lit(None).cast("timestamp_ntz").alias("order_approved_at"),
                    F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
                    F.col("last_ship").alias("order_delivered_customer_date"),
                    (F.col("o_orderdate") + F.expr(f"INTERVAL {ESTIMATED_DELIVERY_DAYS} DAYS"))
                    .alias("order_estimated_delivery_date")))


def _price() -> "F.Column":
    return F.col("l_extendedprice").cast("decimal(12,2)")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.col("l_suppkey").alias("seller_id"),
                     F.col("l_shipdate").alias("shipping_limit_date"),
                     _price().alias("price"),
                     (_price() * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)")
                     .alias("freight_value"))


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("payment_sequential"),
                     F.col("l_returnflag").alias("payment_type"),
                     F.col("l_quantity").cast("int").alias("payment_installments"),
                     _price().alias("payment_value"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_type").alias("product_category_name"),
                    F.length("p_name").alias("product_name_length"),
                    F.lit(None).cast("int").alias("product_description_length"),
                    F.lit(None).cast("int").alias("product_photos_qty"),
                    F.col("p_size").alias("product_weight_g"))


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base translation table before the patch step (some categories missing on purpose)."""
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_type").alias("product_category_name"))
            .where(~F.col("product_category_name").isin(*UNTRANSLATED_TYPES))
            .distinct()
            .select("product_category_name",
                    F.lower("product_category_name").alias("product_category_name_english")))


def order_reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as exported, with several reviews per order (de-duplicated downstream)."""
    e = table(spark, sf_dir, "events")
    message = F.when(F.col("event_type").isin(*EVENTS_WITHOUT_MESSAGE), F.lit(None).cast("string")) \
        .otherwise(F.col("props"))
    return e.select(F.col("event_id").alias("review_id"),
                    F.expr("event_id div 2").alias("order_id"),
                    _case("event_type", SCORE_BY_EVENT).cast("int").alias("review_score"),
                    F.lit(None).cast("string").alias("review_comment_title"),
                    message.alias("review_comment_message"),
                    F.to_date("ts").cast("timestamp_ntz").alias("review_creation_date"),
                    F.col("ts").alias("review_answer_timestamp"))


def state_median_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "inner")
            .groupBy(F.col("n_name").alias("state_code"))
            .agg(F.round(F.avg("s_acctbal"), 2).cast("decimal(12,2)").alias("median_monthly_income_2017")))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.lit(None).cast("string").alias("seller_zip_code_prefix"),
                    F.lit(None).cast("string").alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


ROLE_BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "products": products,
    "category_translation": category_translation,
    "order_reviews_raw": order_reviews_raw,
    "state_median_income": state_median_income,
    "sellers": sellers,
}


class Roles:
    """Lazy accessor: ``Roles(spark, sf_dir).orders`` builds (and memoises) one role DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ROLE_BUILDERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = ROLE_BUILDERS[name](self.spark, self.sf_dir)
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)
