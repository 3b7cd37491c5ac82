"""Model training and scoring with Spark ML: boosted trees or logistic regression on the
modelling set, a seeded random search over a fixed parameter space with stratified folds, class
weighting for the rare positive label, scores, and feature importances.

Features are encoded into vectors once and checkpointed to the session's folder, and every fit reads
those. The fold column comes from ``split.stratified_folds``. Boosted trees whose binned rows are
small enough to broadcast are fitted whole in a task, all folds and candidates side by side
(``boosting``, behind a check of their number). Beyond it training data never leaves the executors:
the fits run in parallel threads on the driver that each submit distributed jobs. That boosting
checkpoints its residuals and keeps the rows' tree nodes (``CHECKPOINT_ROUNDS``), so 800 rounds
don't grow one lineage and a lost executor re-reads files.

A missing value is 0 with an indicator of its own, so a missing rate and a rate of 0 differ.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import boosting

# The search space of the boosted-tree classifier, in its original terms
# (tree depth, minimum child weight, minimum split gain, row subsample, column subsample,
# learning rate).
SEARCH_SPACE = {
    "max_depth": [3, 4, 5, 6],
    "min_child_weight": [1, 3, 5, 10],
    "gamma": [0, 0.5, 1],
    "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
}
DEFAULT_DRAWS = 30
DEFAULT_TREES = 800
CHECKPOINT_ROUNDS = 10
MISSING = "__missing"


def feature_columns(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Every numeric column except the label and the excluded ones (all others are features)."""
    from .profile import numeric_columns
    return [c for c in numeric_columns(df) if c != label and c not in exclude]


def keep_rows(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, for the several passes of a training run: its split and
    joins run once. Partitions and their order stay."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_class_weight(df: DataFrame, label: str, ratio: float | None = None, weight_col: str = "weight") -> DataFrame:
    """Weight ``ratio`` (negatives / positives, computed from ``df`` when not given) on positive
    rows and 1 on negatives: the positive-class weighting of the original model."""
    if ratio is None:
        counts = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
        ratio = float(counts["neg"]) / float(counts["pos"]) if counts["pos"] else 1.0
    return df.withColumn(weight_col, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def assemble(features: Sequence[str], out_col: str = "features") -> VectorAssembler:
    """Features to one vector; missing values become 0 and an indicator beforehand (see :func:`prepare`)."""
    return VectorAssembler(inputCols=list(features), outputCol=out_col, handleInvalid="keep")


def missing_columns(train: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that have missing values in ``train`` (one pass)."""
    if not features:
        return []
    row = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features]).first()
    return [c for c in features if row[c]]


def with_indicators(features: Sequence[str], missing: Sequence[str]) -> list[str]:
    """Names of the prepared features: the features and an indicator for each of ``missing``."""
    return [*features, *(f"{c}{MISSING}" for c in missing)]


def prepare(df: DataFrame, label: str, features: Sequence[str], missing: Sequence[str] = ()) -> DataFrame:
    """Features as doubles, label too (Spark ML's expected types). A missing value is 0, and each of
    ``missing`` gets an indicator column that is 1 where it was missing."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    flags = [F.col(c).isNull().cast("double").alias(f"{c}{MISSING}") for c in missing]
    rest = [c for c in df.columns if c not in features and c != label]
    return df.select(*rest, *cols, *flags, F.col(label).cast("double").alias(label))


def param_draws(n: int = DEFAULT_DRAWS, seed: int = 42, space: dict | None = None) -> list[dict]:
    """``n`` distinct combinations of the search space, drawn without replacement (seeded)."""
    space = space or SEARCH_SPACE
    keys = list(space)
    grid = list(itertools.product(*[space[k] for k in keys]))
    picks = random.Random(seed).sample(range(len(grid)), min(n, len(grid)))
    return [dict(zip(keys, grid[i])) for i in picks]


def gbt(label: str, weight_col: str | None = "weight", max_iter: int = DEFAULT_TREES, seed: int = 42,
        max_bins: int = 256, **params) -> GBTClassifier:
    """Boosted trees; ``params`` use the search-space names and map onto Spark's parameters
    (same roles, not the same numerics: split gain and child weight are on different scales)."""
    est = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, seed=seed, maxBins=max_bins,
                        checkpointInterval=CHECKPOINT_ROUNDS, cacheNodeIds=True)
    if weight_col:
        est.setWeightCol(weight_col)
    return _apply_params(est, params)


def _apply_params(est: GBTClassifier, params: dict) -> GBTClassifier:
    if "max_depth" in params:
        est.setMaxDepth(int(params["max_depth"]))
    if "min_child_weight" in params:
        est.setMinInstancesPerNode(int(params["min_child_weight"]))
    if "gamma" in params:
        est.setMinInfoGain(float(params["gamma"]))
    if "subsample" in params:
        est.setSubsamplingRate(float(params["subsample"]))
    if "colsample_bytree" in params:
        v = float(params["colsample_bytree"])
        est.setFeatureSubsetStrategy("all" if v >= 1.0 else str(v))
    if "learning_rate" in params:
        est.setStepSize(float(params["learning_rate"]))
    return est


def logistic(label: str, weight_col: str | None = "weight", max_iter: int = 100, reg: float = 0.0) -> Pipeline:
    """Logistic regression on standardised features (a pipeline: scaler + model)."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=False, withStd=True)
    lr = LogisticRegression(labelCol=label, featuresCol="scaled", maxIter=max_iter, regParam=reg)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[scaler, lr])


def fit(train: DataFrame, label: str, features: Sequence[str], estimator, prep: Sequence | None = None) -> PipelineModel:
    """Encode ``train`` once (``prep``: feature stages, default assembling ``features``), fit ``estimator``
    (a classifier or a pipeline) on the checkpointed vectors."""
    encoder, encoded = encode_once(train, label, features, prep)
    data = boosting.binned(encoded, estimator) if isinstance(estimator, GBTClassifier) else None
    fitted = estimator.fit(encoded) if data is None else boosting.fit(train.sparkSession, data, estimator)
    return PipelineModel(stages=[*encoder.stages, fitted])


def encode_once(train: DataFrame, label: str, features: Sequence[str], prep: Sequence | None = None,
                keep: Sequence[str] = ("weight",)) -> tuple[PipelineModel, DataFrame]:
    """The fitted feature stages, and the checkpointed frame of ``features`` vectors, label and ``keep``.
    A checkpoint keeps the partitions and their order, so a seeded fit is the same each time."""
    encoder = Pipeline(stages=list(prep) if prep is not None else [assemble(features)]).fit(train)
    columns = ["features", label, *(c for c in keep if c in train.columns)]
    checkpoint_dir(train.sparkSession)
    return encoder, encoder.transform(train).select(*columns).checkpoint(eager=True)


def tune(train: DataFrame, label: str, features: Sequence[str], estimator: GBTClassifier,
         draws: Sequence[dict], fold_col: str = "fold", parallelism: int = 4,
         prep: Sequence | None = None) -> tuple[PipelineModel, DataFrame]:
    """Random search with cross-validation on a fold column, scored by ROC-AUC; returns the
    pipeline refitted on all training rows with the best parameters (of equal ones the first), and
    one row per candidate.

    ``prep`` are the feature stages (default: assemble ``features``; pass ``sparse_encoder(...)``
    for sparse one-hot input). They are fitted on all of ``train`` once, whose rows are checkpointed
    as vectors with their fold; fits of every fold and candidate share them. They run one a task, or
    ``parallelism`` at a time where the rows are too many for a task.
    """
    spark = train.sparkSession
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC")
    encoder, encoded = encode_once(train, label, features, prep, keep=("weight", fold_col))
    folds = sorted(r[0] for r in encoded.select(fold_col).distinct().collect())  # ``Config.folds`` rows
    candidates = [_apply_params(estimator.copy(), d) for d in draws]

    def auc(job: tuple[int, int]) -> float:
        i, k = job
        fitted = candidates[i].fit(encoded.where(F.col(fold_col) != k))
        return float(evaluator.evaluate(fitted.transform(encoded.where(F.col(fold_col) == k))))

    jobs = [(i, k) for i in range(len(candidates)) for k in folds]
    data = boosting.binned(encoded, estimator, fold_col)
    if data is not None:
        found = boosting.fold_aucs(spark, data, [(boosting.params_of(candidates[i]), k) for i, k in jobs])
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            found = list(pool.map(auc, jobs))
    means = [sum(found[i * len(folds):(i + 1) * len(folds)]) / len(folds) for i in range(len(candidates))]
    best = candidates[max(range(len(means)), key=lambda i: (means[i], -i))]
    keys = list(draws[0].keys()) if draws else []
    rows = [(i, *[float(draws[i][k]) for k in keys], m) for i, m in enumerate(means)]
    results = spark.createDataFrame(rows, ["candidate"] + keys + ["mean_cv_auc"])
    fitted = best.fit(encoded) if data is None else boosting.fit(spark, data, best)
    return PipelineModel(stages=[*encoder.stages, fitted]), results


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], label: str | None = None) -> DataFrame:
    """Positive-class probability (``y_proba``) and the model's own class (``prediction``)."""
    out = model.transform(df)
    cols = list(keep) + ([F.col(label).cast("int").alias("y_true")] if label else [])
    return out.select(*cols, vector_to_array("probability")[1].alias("y_proba"),
                      F.col("prediction").cast("int").alias("prediction"))


def feature_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance) of the tree model, highest first (ties by name)."""
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    return (spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
            .orderBy(F.col("importance").desc(), F.col("feature").asc()))


def sparse_encoder(categorical: Sequence[str], numeric: Sequence[str], out_col: str = "features") -> list:
    """Stages that one-hot ``categorical`` into sparse vectors and assemble them with ``numeric``.

    The wide 0/1 frame is never built (hundreds of level columns would exceed whole-stage code
    generation's field limit). Levels are sorted and none is dropped, as in ``encode.one_hot``.
    When the training rows contain NULLs, NULL and unseen values share one extra "missing"
    indicator after the real levels (the dense encoding gives all zeros instead; for a tree model
    both carry the same information); otherwise they encode as all zeros.
    """
    idx = [f"{c}__idx" for c in categorical]
    vec = [f"{c}__vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + vec, outputCol=out_col, handleInvalid="keep"))
    return stages


def sparse_feature_names(model: PipelineModel, categorical: Sequence[str], numeric: Sequence[str]) -> list[str]:
    """Feature names in vector order: numeric columns, then ``{column}_{level}`` per level."""
    names = list(numeric)
    if categorical:
        indexer = model.stages[0]
        encoder = model.stages[1]
        for c, labels, size in zip(categorical, indexer.labelsArray, encoder.categorySizes):
            names += [f"{c}_{lv}" for lv in labels] + [f"{c}_missing"] * (size - len(labels))
    return names
