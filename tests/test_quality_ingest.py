from firstbasket import schemas
from firstbasket.operators import quality
from firstbasket.schemas import PRIMARY_KEYS
from firstbasket.sources import files


def test_unique_orphans_nulls_and_surrogate(spark):
    items = spark.createDataFrame([("o1", 1), ("o1", 1), ("o2", 1), ("o9", 1), (None, 2)], "order_id string, order_item_id int")
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    assert [tuple(r) for r in quality.unique_key_violations(items, ["order_id", "order_item_id"]).collect()] == [("o1", 1, 2)]
    assert [r["order_id"] for r in quality.orphans(items, orders, ["order_id"]).collect()] == ["o9"]
    nulls = {r["column_name"]: r["null_rows"] for r in quality.null_report(items, ["order_id", "order_item_id"]).collect()}
    assert nulls == {"order_id": 1, "order_item_id": 0}
    sk = sorted(r["sk"] for r in quality.surrogate_key(items, ["order_id", "order_item_id"]).collect())
    assert sk == [1, 2, 3, 4, 5]


def test_csv_positional_binding_with_multiline_text(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('anything,whatever,x,y,z,c1,c2\n'
                    'o1,r1,5,,"line one\nline two, with comma",2020-01-01 00:00:00,2020-01-02 10:00:00\n')
    df = files.read_csv(spark, str(path), schemas.ORDER_REVIEWS)
    r = df.first()
    assert df.columns == schemas.ORDER_REVIEWS.fieldNames()
    assert r["order_id"] == "o1" and r["review_score"] == 5 and "line two" in r["review_comment_message"]


def test_sparse_encoder_matches_dense_one_hot(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml import Pipeline

    from firstbasket.operators import encode, model
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 3.0), (3, None, 4.0)], "id int, c string, x double")
    pm = Pipeline(stages=model.sparse_encoder(["c"], ["x"])).fit(df)
    got = {r["id"]: r["v"] for r in pm.transform(df).select("id", vector_to_array("features").alias("v")).collect()}
    dense = {r["id"]: [r["x"], r["c_a"], r["c_b"]] for r in encode.one_hot(df, ["c"]).collect()}
    assert {k: v[:3] for k, v in got.items()} == {k: [float(v) for v in vals] for k, vals in dense.items()}
    assert [v[3] for _, v in sorted(got.items())] == [0.0, 0.0, 1.0]
    assert model.sparse_feature_names(pm, ["c"], ["x"]) == ["x", "c_a", "c_b", "c_missing"]
    unseen = spark.createDataFrame([(9, "zzz", 1.0)], "id int, c string, x double")
    assert pm.transform(unseen).select(vector_to_array("features").alias("v")).first()["v"] == [1.0, 0.0, 0.0, 1.0]


def test_param_draws_are_distinct_and_seeded():
    from firstbasket.operators import model
    a, b = model.param_draws(30, 42), model.param_draws(30, 42)
    assert a == b and len({tuple(d.items()) for d in a}) == 30
    assert all(d["max_depth"] in (3, 4, 5, 6) for d in a)


def test_nan_becomes_null_on_ingest(spark, tmp_path):
    from pyspark.sql.types import DoubleType, StructField, StructType
    path = tmp_path / "x.csv"
    path.write_text("a\nNaN\n1.5\n")
    df = files.read_csv(spark, str(path), StructType([StructField("a", DoubleType())]))
    assert sorted([r["a"] for r in df.collect()], key=lambda v: (v is not None, v)) == [None, 1.5]


def test_save_table_in_namespace(spark, tmp_path):
    files.use_namespace(spark, "fb_test")
    name = files.save_table(spark.range(3), "t", "fb_test")
    assert spark.table(name).count() == 3
    spark.catalog.setCurrentDatabase("default")


def test_pipeline_end_to_end_smallest_tables(spark, tmp_path):
    from firstbasket.config import DEFAULT
    from firstbasket.plans import pipeline
    from firstbasket.plans.sources import testbed_sources
    paths = pipeline.run(spark, testbed_sources(spark, "/root/testdata/sf0.001"), DEFAULT, str(tmp_path / "run"),
                         trees=3, draws=2)
    lift = spark.read.parquet(paths["lift"]).collect()
    assert sum(r["customers"] for r in lift) == spark.read.parquet(paths["scores"]).count()
    assert spark.read.parquet(paths["abt"]).count() == 137
    imp = spark.read.parquet(paths["importance"]).collect()
    assert any(r["feature"].startswith("customer_state_") for r in imp)


def test_duplicate_keys_of_every_table_are_reported(spark):
    tables = {"sellers": spark.createDataFrame([("s1",), ("s1",), ("s2",)], "seller_id string"),
              "order_items": spark.createDataFrame([("o1", 1), ("o1", 1), ("o1", 2)], "order_id string, order_item_id int")}
    got = quality.unique_key_report(tables, {"sellers": ("seller_id",), "order_items": ("order_id", "order_item_id")})
    assert sorted(map(tuple, got.collect())) == [("order_items", "order_id,order_item_id", ["o1", "1"], 2), ("sellers", "seller_id", ["s1"], 2)]


def test_the_registered_key_report_reads_every_mapped_table(spark):
    from firstbasket.plans.catalog import REGISTRY
    plan = REGISTRY["dq_unique_keys"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"{t} AS table_name" in plan for t in PRIMARY_KEYS if t != "geolocation")  # which has no role here
