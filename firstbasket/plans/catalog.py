"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over the test tables.

Each entry runs an operator (or a composite) of the package on the role mapping of the given
tables, over whole tables. The DuckDB oracle for the same name lives in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT as CFG
from ..operators import cohort, encode, features
from ..operators.cohort import PERSON
from ..operators.rank import segment_row_number
from ..sources import testbed
from . import abt as abt_plan
from .sources import testbed_sources

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- shared building blocks

_PLAN_CACHE: dict = {}


def _memo(kind: str, spark, sf_dir, build):
    """Reuse lazily built source plans within one Spark application (plans only: nothing is
    computed or cached, every query still reads and processes the whole tables)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        app = spark.conf.get("spark.app.id", "")
    key = (kind, app, id(spark), sf_dir)
    if key not in _PLAN_CACHE:
        _PLAN_CACHE[key] = build()
    return _PLAN_CACHE[key]


def _roles(spark, sf_dir) -> testbed.Roles:
    return _memo("roles", spark, sf_dir, lambda: testbed.Roles(spark, sf_dir))


def _delivered(spark, sf_dir) -> DataFrame:
    r = _roles(spark, sf_dir)
    return cohort.delivered_orders(r.orders, r.customers, CFG)


def _spine(spark, sf_dir) -> DataFrame:
    return cohort.first_order_spine(_delivered(spark, sf_dir), CFG)


def _label(spark, sf_dir) -> DataFrame:
    d = _delivered(spark, sf_dir)
    return cohort.reorder_label(cohort.first_order_spine(d, CFG), d, CFG)


def _sources(spark, sf_dir):
    return _memo("sources", spark, sf_dir, lambda: testbed_sources(spark, sf_dir, _roles(spark, sf_dir)))


def _base(spark, sf_dir) -> DataFrame:
    """The base table's own columns, without rates: planned without running a job."""
    return abt_plan.base_rows(_sources(spark, sf_dir), CFG)


def _abt(spark, sf_dir) -> DataFrame:
    return abt_plan.build_abt(_sources(spark, sf_dir), CFG)


def _bi(spark, sf_dir) -> DataFrame:
    return abt_plan.bi_view(_base(spark, sf_dir))


# ---------------------------------------------------------------- cohort (spine and label)

@register("dataset_bounds")
def q_dataset_bounds(spark, sf_dir):
    return cohort.dataset_bounds(_roles(spark, sf_dir).orders, CFG)


@register("delivered_orders")
def q_delivered_orders(spark, sf_dir):
    return _delivered(spark, sf_dir).select(PERSON, "customer_id", "order_id", cohort.PURCHASE)


@register("order_sequence")
def q_order_sequence(spark, sf_dir):
    d = _delivered(spark, sf_dir).select(PERSON, "customer_id", "order_id", cohort.PURCHASE)
    return segment_row_number(d, [PERSON], [F.col(cohort.PURCHASE).asc_nulls_last(), F.col("order_id")],
                              out_col="order_sequential")


@register("first_order_spine")
def q_first_order_spine(spark, sf_dir):
    return _spine(spark, sf_dir).select("customer_id", PERSON, "first_order_id", "first_order_timestamp")


@register("reorder_events")
def q_reorder_events(spark, sf_dir):
    d = _delivered(spark, sf_dir)
    return cohort.reorder_events(cohort.first_order_spine(d, CFG), d, CFG)


@register("reorder_label")
def q_reorder_label(spark, sf_dir):
    return _label(spark, sf_dir).select(PERSON, "first_order_id", "first_order_timestamp", "reordered_180d")


# ---------------------------------------------------------------- feature frames

@register("delivery_features")
def q_delivery_features(spark, sf_dir):
    return features.delivery_features(_spine(spark, sf_dir)).select(
        PERSON, "first_order_id", "days_to_deliver", "actual_vs_estimated_delivery_days")


@register("item_features")
def q_item_features(spark, sf_dir):
    return features.item_features(_spine(spark, sf_dir), _roles(spark, sf_dir).order_items)


@register("review_features")
def q_review_features(spark, sf_dir):
    src = _sources(spark, sf_dir)
    return features.review_features(_spine(spark, sf_dir), src.order_reviews)


@register("payment_features")
def q_payment_features(spark, sf_dir):
    return features.payment_features(_spine(spark, sf_dir), _roles(spark, sf_dir).order_payments)


@register("dominant_category")
def q_dominant_category(spark, sf_dir):
    src = _sources(spark, sf_dir)
    return features.dominant_category(_spine(spark, sf_dir), src.order_items, src.products,
                                      src.category_translation)


def _category_label(spark, sf_dir) -> DataFrame:
    src = _sources(spark, sf_dir)
    lab = _label(spark, sf_dir)
    cat = features.dominant_category(lab, src.order_items, src.products, src.category_translation)
    return cat.join(lab.select(PERSON, "first_order_id", "reordered_180d"), [PERSON, "first_order_id"], "inner")


@register("category_reorder_rate")
def q_category_reorder_rate(spark, sf_dir):
    return encode.group_rate(_category_label(spark, sf_dir), "first_order_category", "reordered_180d", "category")


@register("category_features")
def q_category_features(spark, sf_dir):
    src = _sources(spark, sf_dir)
    lab = _label(spark, sf_dir)
    cat = features.dominant_category(lab, src.order_items, src.products, src.category_translation)
    rates = encode.group_rate(_category_label(spark, sf_dir), "first_order_category", "reordered_180d", "category")
    return (cat.join(rates.select("first_order_category", "category_reorder_rate"), "first_order_category", "left")
            .select(PERSON, "first_order_id", "first_order_category", "category_reorder_rate"))


@register("state_reorder_rate")
def q_state_reorder_rate(spark, sf_dir):
    return encode.group_rate(_label(spark, sf_dir), "customer_state", "reordered_180d", "state")


@register("state_features")
def q_state_features(spark, sf_dir):
    lab = _label(spark, sf_dir)
    base = features.state_base(lab, _roles(spark, sf_dir).customers).join(
        lab.select(PERSON, "first_order_id", "reordered_180d"), [PERSON, "first_order_id"], "inner")
    income = _roles(spark, sf_dir).state_median_income.select(
        F.col("state_code").alias("customer_state"),
        F.col("median_monthly_income_2017").alias("state_median_monthly_income"))
    enc = encode.target_encode(base, "customer_state", "reordered_180d", "state")
    return enc.join(income, "customer_state", "left").select(
        PERSON, "first_order_id", "customer_state", "state_median_monthly_income", "state_reorder_rate")


@register("target_encode")
def q_target_encode(spark, sf_dir):
    """Generic encoder on another column: the label rate of each first-order payment type."""
    a = _abt(spark, sf_dir)
    enc = encode.target_encode(a.select(PERSON, "primary_payment_type", "reordered_180d"),
                               "primary_payment_type", "reordered_180d", "payment_type")
    return enc.select(PERSON, "primary_payment_type", "payment_type_reorder_rate")


# ---------------------------------------------------------------- base table and view

@register("abt")
def q_abt(spark, sf_dir):
    return _abt(spark, sf_dir)


@register("abt_export")
def q_abt_export(spark, sf_dir):
    """The ordered export, written and read again, with each row's place over the files in order."""
    import uuid

    from ..session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports/abt_{uuid.uuid4().hex}"
    out = abt_plan.for_export(_base(spark, sf_dir).select(PERSON, "first_order_id", "reordered_180d"))
    return files.with_file_position(files.materialize(out, path), "export_row")


@register("bi_view")
def q_bi_view(spark, sf_dir):
    return _bi(spark, sf_dir)


# ---------------------------------------------------------------- quality, de-duplication, ingest

from ..operators import dedup, kpi, quality  # noqa: E402
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, not_null_columns  # noqa: E402
from ..sources import files  # noqa: E402
from ..sources.dimensions import fill_unknown  # noqa: E402
from .sources import patched_translation, reviews_deduplicated  # noqa: E402


def _loaded_tables(spark, sf_dir) -> dict[str, DataFrame]:
    r = _roles(spark, sf_dir)
    return {
        "customers": r.customers, "orders": r.orders, "order_items": r.order_items,
        "order_payments": r.order_payments, "order_reviews": reviews_deduplicated(r),
        "products": fill_unknown(r.products), "sellers": r.sellers,
        "category_translation": patched_translation(r), "state_median_income": r.state_median_income,
    }


@register("dq_unique_key")
def q_dq_unique_key(spark, sf_dir):
    return quality.unique_key_violations(_roles(spark, sf_dir).order_items, PRIMARY_KEYS["order_items"])


@register("dq_unique_keys")
def q_dq_unique_keys(spark, sf_dir):
    report = quality.unique_key_report(_loaded_tables(spark, sf_dir), PRIMARY_KEYS)
    return report.withColumn("key_values", F.array_join("key_values", ",", "NULL"))


@register("dq_orphans")
def q_dq_orphans(spark, sf_dir):
    return quality.orphan_report(FOREIGN_KEYS, _loaded_tables(spark, sf_dir))


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    tables = _loaded_tables(spark, sf_dir)
    return quality.not_null_violations(tables, {t: not_null_columns(t) for t in tables})


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    s = _roles(spark, sf_dir).sellers.select("seller_id", "seller_state")
    return quality.surrogate_key(s, [F.col("seller_id")], name="seller_sk")


@register("review_dedup")
def q_review_dedup(spark, sf_dir):
    return reviews_deduplicated(_roles(spark, sf_dir))


@register("duplicate_rows")
def q_duplicate_rows(spark, sf_dir):
    return dedup.duplicate_rows(_roles(spark, sf_dir).order_reviews_raw, "order_id", sort_by="review_answer_timestamp")


@register("duplicate_key_counts")
def q_duplicate_key_counts(spark, sf_dir):
    return dedup.duplicate_key_counts(_roles(spark, sf_dir).order_reviews_raw, "order_id", 5)


@register("patch_dimension")
def q_patch_dimension(spark, sf_dir):
    return patched_translation(_roles(spark, sf_dir))


@register("fill_unknown_category")
def q_fill_unknown_category(spark, sf_dir):
    return fill_unknown(_roles(spark, sf_dir).products).select("product_id", "product_category_name")


@register("csv_scan_roundtrip")
def q_csv_scan_roundtrip(spark, sf_dir):
    """Export the reporting view as CSV to the shared checkpoint folder and scan it back with the
    declared schema bound by position."""
    import uuid

    from ..session import checkpoint_dir
    bi = _bi(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports/bi_view_{uuid.uuid4().hex}"
    files.write_csv(bi, path)
    return files.read_csv(spark, path, bi.schema)


# ---------------------------------------------------------------- dashboard KPIs

@register("kpi_overall")
def q_kpi_overall(spark, sf_dir):
    return kpi.overall(_bi(spark, sf_dir))


@register("kpi_monthly")
def q_kpi_monthly(spark, sf_dir):
    return kpi.monthly(_bi(spark, sf_dir))


@register("kpi_late")
def q_kpi_late(spark, sf_dir):
    return kpi.late_vs_on_time(_bi(spark, sf_dir))


@register("kpi_review_score")
def q_kpi_review_score(spark, sf_dir):
    return kpi.by(_bi(spark, sf_dir), "first_order_review_score")


@register("kpi_category")
def q_kpi_category(spark, sf_dir):
    return kpi.ranked_categories(_bi(spark, sf_dir))


@register("kpi_basket_size")
def q_kpi_basket_size(spark, sf_dir):
    return kpi.by(_bi(spark, sf_dir), "first_order_item_count")


@register("kpi_state")
def q_kpi_state(spark, sf_dir):
    return kpi.by(_bi(spark, sf_dir), "customer_state")


@register("kpi_overview")
def q_kpi_overview(spark, sf_dir):
    return kpi.overview(_bi(spark, sf_dir))


# ---------------------------------------------------------------- profiling, cleaning, correlation

from ..operators import clean, profile  # noqa: E402


def _clean(spark, sf_dir, keep=()) -> DataFrame:
    return clean.clean_abt(_abt(spark, sf_dir), keep=keep)


@register("frame_shape")
def q_frame_shape(spark, sf_dir):
    return profile.frame_shape(_abt(spark, sf_dir))


@register("distinct_counts")
def q_distinct_counts(spark, sf_dir):
    return profile.distinct_counts(_roles(spark, sf_dir).order_reviews_raw)


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return profile.null_counts(_abt(spark, sf_dir))


@register("non_null_counts")
def q_non_null_counts(spark, sf_dir):
    return profile.non_null_counts(_abt(spark, sf_dir)).drop("data_type")


@register("null_rows")
def q_null_rows(spark, sf_dir):
    return profile.null_rows(_abt(spark, sf_dir), "first_order_review_score").select(
        PERSON, "first_order_id", "first_order_review_score", "review_comment_flag")


def _abt_numeric(a: DataFrame) -> list[str]:
    return profile.numeric_columns(a, exclude=clean.IDENTIFIERS)


@register("describe_numeric")
def q_describe_numeric(spark, sf_dir):
    a = _abt(spark, sf_dir)
    return profile.describe_numeric(a, _abt_numeric(a))


@register("describe_categorical")
def q_describe_categorical(spark, sf_dir):
    return profile.describe_categorical(_abt(spark, sf_dir))


@register("describe_identifiers")
def q_describe_identifiers(spark, sf_dir):
    """Count, distinct values and most frequent value of the id columns, whatever their type."""
    return profile.describe_categorical(_base(spark, sf_dir), [PERSON, "first_order_id"])


@register("describe_datetime")
def q_describe_datetime(spark, sf_dir):
    return profile.describe_datetime(_base(spark, sf_dir).select("first_order_timestamp"))


@register("histogram_datetime")
def q_histogram_datetime(spark, sf_dir):
    """Bounds in microseconds since 1970."""
    return profile.histogram(profile.as_micros(_base(spark, sf_dir).select("first_order_timestamp")), bins=10)


@register("quantiles")
def q_quantiles(spark, sf_dir):
    q = profile.exact_quantiles(_base(spark, sf_dir), ["review_response_delay_days"], [0.1, 0.99])
    return q.select("prob", F.round("value", profile.ROUND).alias("value"))


@register("value_counts")
def q_value_counts(spark, sf_dir):
    return profile.value_counts(_base(spark, sf_dir), "reordered_180d")


@register("value_shares")
def q_value_shares(spark, sf_dir):
    return profile.value_shares(_base(spark, sf_dir), "reordered_180d")


@register("type_family_counts")
def q_type_family_counts(spark, sf_dir):
    return profile.type_family_counts(_abt(spark, sf_dir))


@register("histogram")
def q_histogram(spark, sf_dir):
    a = _abt(spark, sf_dir)
    return profile.histogram(a, _abt_numeric(a), bins=10)


@register("preview")
def q_preview(spark, sf_dir):
    """The first rows of the base table in its stored order (by person): a top-k, not a sample."""
    return _abt(spark, sf_dir).orderBy(PERSON).limit(5)


@register("impute_flags")
def q_impute_flags(spark, sf_dir):
    a = _base(spark, sf_dir).select(PERSON, *clean.FILL_ZERO)
    return clean.impute_reviews(a)


@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    return clean.calendar_features(_base(spark, sf_dir).select(PERSON, "first_order_timestamp"))


@register("late_flag")
def q_late_flag(spark, sf_dir):
    a = clean.narrow_types(_base(spark, sf_dir).select(PERSON, "actual_vs_estimated_delivery_days"))
    return clean.add_late_flag(a)


@register("one_hot")
def q_one_hot(spark, sf_dir):
    a = _base(spark, sf_dir).select(PERSON, *clean.CATEGORICAL)
    return encode.one_hot(a, list(clean.CATEGORICAL), dtype="tinyint")


@register("one_hot_long")
def q_one_hot_long(spark, sf_dir):
    return encode.one_hot_long(_base(spark, sf_dir), PERSON, list(clean.CATEGORICAL))


@register("abt_clean")
def q_abt_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("label_correlation")
def q_label_correlation(spark, sf_dir):
    return profile.label_correlation(_clean(spark, sf_dir), "reordered_180d")


@register("corr_extremes")
def q_corr_extremes(spark, sf_dir):
    return profile.correlation_extremes(profile.label_correlation(_clean(spark, sf_dir), "reordered_180d"), 10)


@register("corr_top_abs")
def q_corr_top_abs(spark, sf_dir):
    return profile.correlation_top_abs(profile.label_correlation(_clean(spark, sf_dir), "reordered_180d"), 25)


# ---------------------------------------------------------------- split, folds, evaluation, lift

from ..operators import metrics, split  # noqa: E402

LABEL = "reordered_180d"
# Cut-off used to turn the deterministic baseline score into a class for the confusion matrix and
# the classification report (the baseline's scores sit far below 0.5).
BASELINE_CUTOFF = 0.2


def baseline_score() -> "F.Column":
    """A model-free score: the mean of the person's category and state reorder rates (the state
    rate alone when the first order has no translated category)."""
    return F.coalesce((F.col("category_reorder_rate") + F.col("state_reorder_rate")) / 2,
                      F.col("state_reorder_rate"))


def _split(spark, sf_dir) -> DataFrame:
    a = _abt(spark, sf_dir).select(PERSON, LABEL, "category_reorder_rate", "state_reorder_rate")
    return split.stratified_split(a, LABEL, PERSON, CFG.test_share, CFG.seed)


def _scored(spark, sf_dir) -> DataFrame:
    return (_split(spark, sf_dir).where(F.col("is_test") == 1)
            .select(PERSON, F.col(LABEL).alias("y_true"), baseline_score().alias("y_proba")))


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(PERSON, LABEL, "is_test")


@register("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    a = _base(spark, sf_dir).select(PERSON, LABEL)
    flagged = split.stratified_split(a, LABEL, PERSON, CFG.test_share, CFG.seed, folds=CFG.folds)
    return flagged.where(F.col("is_test") == 0).select(PERSON, LABEL, "fold")


@register("imbalance_ratio")
def q_imbalance_ratio(spark, sf_dir):
    return metrics.imbalance_ratio(_split(spark, sf_dir), LABEL, F.col("is_test") == 0)


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return metrics.confusion_counts(s, "y_true", (F.col("y_proba") >= BASELINE_CUTOFF).cast("int"))


@register("classification_report")
def q_classification_report(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return metrics.classification_report(s, "y_true", (F.col("y_proba") >= BASELINE_CUTOFF).cast("int"))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scored(spark, sf_dir), "y_true", "y_proba")


@register("roc_curve")
def q_roc_curve(spark, sf_dir):
    return metrics.roc_curve(_scored(spark, sf_dir), "y_true", "y_proba")


@register("threshold_sweep")
def q_threshold_sweep(spark, sf_dir):
    return metrics.threshold_sweep(_scored(spark, sf_dir), "y_true", "y_proba", CFG.sweep_thresholds)


@register("threshold_report")
def q_threshold_report(spark, sf_dir):
    return metrics.threshold_report(_scored(spark, sf_dir), "y_true", "y_proba", CFG.sweep_thresholds)


@register("score_histogram")
def q_score_histogram(spark, sf_dir):
    return profile.histogram(_scored(spark, sf_dir), ["y_proba"], bins=50)


@register("score_summary")
def q_score_summary(spark, sf_dir):
    return metrics.score_summary(_scored(spark, sf_dir), "y_proba")


@register("score_table")
def q_score_table(spark, sf_dir):
    return metrics.score_table(_scored(spark, sf_dir), "y_proba", PERSON)


@register("score_deciles")
def q_score_deciles(spark, sf_dir):
    return metrics.score_deciles(_scored(spark, sf_dir), "y_proba", PERSON, CFG.deciles)


@register("lift_table")
def q_lift_table(spark, sf_dir):
    return metrics.lift_table(_scored(spark, sf_dir), "y_true", "y_proba", PERSON, CFG.deciles)


@register("lift_top_pct")
def q_lift_top_pct(spark, sf_dir):
    return metrics.lift_top_pct(_scored(spark, sf_dir), "y_true", "y_proba", PERSON, 20.0)


@register("lift_top_quarter")
def q_lift_top_quarter(spark, sf_dir):
    return metrics.lift_top_pct(_scored(spark, sf_dir), "y_true", "y_proba", PERSON, 25.0)


# ---------------------------------------------------------------- training and scoring (rows-only checks)

from ..operators import model  # noqa: E402


def _model_sets(spark, sf_dir):
    cleaned = _clean(spark, sf_dir, keep=(PERSON,))
    # Read by the missing counts, the class weight, the encoding and the scoring; a checkpoint keeps the
    # partitions and their order, so the seeded fits are the same as on the plan itself.
    flagged = model.keep_rows(split.stratified_split(cleaned, LABEL, PERSON, CFG.test_share, CFG.seed, folds=CFG.folds))
    features = model.feature_columns(flagged, LABEL, exclude=(PERSON, "is_test", "fold"))
    missing = model.missing_columns(flagged.where(F.col("is_test") == 0), features)
    prepared = model.prepare(flagged, LABEL, features, missing)
    train = model.with_class_weight(prepared.where(F.col("is_test") == 0), LABEL)
    test = prepared.where(F.col("is_test") == 1)
    return train, test, model.with_indicators(features, missing)


def _search(spark, sf_dir):
    """(tuned model, candidates, test rows, features) of the whole search of ``Config``."""
    train, test, features = _model_sets(spark, sf_dir)
    est = model.gbt(LABEL, max_iter=CFG.trees, seed=CFG.seed)
    best, results = model.tune(train, LABEL, features, est, model.param_draws(CFG.draws, CFG.seed), parallelism=CFG.parallel_fits)
    return best, results, test, features


@register("train_classifier")
def q_train_classifier(spark, sf_dir):
    """The untuned fit: a depth of 6 is what the reference's library takes where none is given."""
    train, test, features = _model_sets(spark, sf_dir)
    m = model.fit(train, LABEL, features, model.gbt(LABEL, max_iter=CFG.trees, max_depth=6, seed=CFG.seed))
    return model.score(m, test, [PERSON], LABEL)


@register("train_logistic")
def q_train_logistic(spark, sf_dir):
    train, test, features = _model_sets(spark, sf_dir)
    m = model.fit(train, LABEL, features, model.logistic(LABEL, max_iter=CFG.logistic_iterations))
    return model.score(m, test, [PERSON], LABEL)


@register("param_draws")
def q_param_draws(spark, sf_dir):
    """The draws of the search, with the positive-class weight that every fit of them uses."""
    train, _, _ = _model_sets(spark, sf_dir)
    draws = model.param_draws(CFG.draws, CFG.seed)
    keys = list(draws[0])
    rows = spark.createDataFrame([(i, *[float(d[k]) for k in keys]) for i, d in enumerate(draws)], ["candidate", *keys])
    return rows.crossJoin(train.agg(F.max("weight").alias("positive_weight")))  # one row


@register("tune_classifier")
def q_tune_classifier(spark, sf_dir):
    return _search(spark, sf_dir)[1]


@register("score_customers")
def q_score_customers(spark, sf_dir):
    """Test customers scored by the tuned model, with their ranks."""
    best, _, test, _ = _search(spark, sf_dir)
    return metrics.score_table(model.score(best, test, [PERSON], LABEL), "y_proba", PERSON)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    best, _, _, features = _search(spark, sf_dir)
    return model.feature_importance(best, features, spark).limit(50)


@register("model_lift_table")
def q_model_lift_table(spark, sf_dir):
    best, _, test, _ = _search(spark, sf_dir)
    return metrics.lift_table(model.score(best, test, [PERSON], LABEL), "y_true", "y_proba", PERSON, CFG.deciles)
