import pytest
from pyspark.sql import functions as F

from firstbasket.operators import metrics, model


def _data(spark):
    rows = [(i, float(i % 7), float((i * 13) % 5), 1 if (i % 7) >= 5 or i % 11 == 0 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    return model.with_class_weight(model.prepare(df, "y", ["a", "b"]), "y")


def test_seeded_gbt_is_reproducible_and_auc_in_range(spark):
    df = _data(spark)
    runs = []
    for _ in range(2):
        m = model.fit(df, "y", ["a", "b"], model.gbt("y", max_iter=5, max_depth=3, seed=7))
        runs.append(sorted((r["id"], round(r["y_proba"], 12)) for r in model.score(m, df, ["id"], "y").collect()))
    assert runs[0] == runs[1]
    scored = model.score(m, df, ["id"], "y")
    auc = metrics.roc_auc(scored, "y_true", "y_proba").first()["roc_auc"]
    assert 0.5 < auc <= 1.0
    imp = model.feature_importance(m, ["a", "b"], spark).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9


def test_class_weight_is_negative_to_positive_ratio(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = {r["y"]: r["weight"] for r in model.with_class_weight(df, "y").select("y", "weight").distinct().collect()}
    assert w == {0: 1.0, 1: 3.0}


def test_missing_and_zero_give_different_vectors(spark):
    df = spark.createDataFrame([(1, None, "x", 1), (2, 0.0, "x", 0), (3, 0.5, None, 0)], "id long, rate double, kind string, y int")
    assert model.missing_columns(df, ["rate"]) == ["rate"]
    prepared = model.prepare(df, "y", ["rate"], ["rate"])
    names = model.with_indicators(["rate"], ["rate"])
    dense = {r.id: r.features.toArray().tolist() for r in model.assemble(names).transform(prepared).collect()}
    assert dense == {1: [0.0, 1.0], 2: [0.0, 0.0], 3: [0.5, 0.0]}
    encoder, _ = model.encode_once(prepared, "y", names, model.sparse_encoder(["kind"], names), keep=())
    sparse = {r.id: r.features.toArray().tolist() for r in encoder.transform(prepared).collect()}
    assert sparse[1] != sparse[2] and sparse[1][2:] == sparse[2][2:]


def test_search_runs_every_draw_on_every_fold(spark):
    df = _data(spark).withColumn("fold", (F.col("id") % 3).cast("int"))
    draws = model.param_draws(3, 5)
    best, results = model.tune(df, "y", ["a", "b"], model.gbt("y", max_iter=12, seed=7), draws)
    got = results.orderBy("candidate").collect()
    assert [r.max_depth for r in got] == [d["max_depth"] for d in draws] and all(0.5 < r.mean_cv_auc <= 1 for r in got)
    tree = best.stages[-1]
    first = max(got, key=lambda r: (r.mean_cv_auc, -r.candidate))
    assert tree.getMaxDepth() == first.max_depth and tree.getStepSize() == first.learning_rate and len(tree.trees) <= 12
    assert tree.getCheckpointInterval() == model.CHECKPOINT_ROUNDS and tree.getCacheNodeIds()


def test_default_search_is_the_whole_one():
    from firstbasket.config import Config
    assert (Config().draws, Config().trees) == (model.DEFAULT_DRAWS, model.DEFAULT_TREES) == (30, 800)


def test_training_passes_read_the_split_rows_once_written(spark, monkeypatch):
    from firstbasket.plans import catalog
    rows = [(i, float(i % 7) if i % 9 else None, "x" if i % 2 else "y", int(i % 5 == 0)) for i in range(60)] + [(3, 1.0, "x", 0), (None, 2.0, "y", 0)]
    df = spark.createDataFrame(rows, f"{catalog.PERSON} long, a double, kind string, {catalog.LABEL} int")
    monkeypatch.setattr(catalog, "_clean", lambda *args, **kw: df)
    train, test, features = catalog._model_sets(spark, "unused")
    assert features == ["a", "a__missing"] and train.count() + test.count() == len(rows)
    for part in (train, test):  # the split's passes and joins are not in the plan of any pass
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" in plan and "MapInArrow" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["tune_classifier", "train_classifier", "score_customers", "model_lift_table", "feature_importance"])
def test_registered_training_runs_every_round_and_draw(spark, monkeypatch, name):
    from firstbasket.plans import catalog
    rows = [(i, float(i % 7), int(i % 5 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, f"{catalog.PERSON} long, a double, {catalog.LABEL} int")
    monkeypatch.setattr(catalog, "_clean", lambda *args, **kw: df)
    asked = []

    def short(run, at):  # what was asked for, then a run that ends soon
        def call(*args, **kw):
            asked.append((args[3].getMaxIter(), len(args[4]) if at else None))
            args = [*args[:3], args[3].copy().setMaxIter(1), *([args[4][:1]] if at else [])]
            return run(*args, **kw)
        return call

    monkeypatch.setattr(model, "tune", short(model.tune, 1))
    monkeypatch.setattr(model, "fit", short(model.fit, 0))
    assert catalog.REGISTRY[name](spark, "unused").count() > 0
    assert asked == [(800, None if name == "train_classifier" else 30)]
