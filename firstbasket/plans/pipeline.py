"""End-to-end batch run: base table -> reporting view -> cleaned set -> model -> scores and lift.

Every stage boundary is a Parquet table written under ``out_dir`` (a shared folder on a cluster;
by default under the session's checkpoint folder), so each stage re-reads files rather than
re-running the previous stage's shuffles, and a re-run overwrites its outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import clean, encode, metrics, model, split
from ..operators.cohort import PERSON
from ..session import checkpoint_dir
from ..sources import files
from .abt import Sources, bi_view, build_abt, for_export

LABEL = "reordered_180d"


def run(spark: SparkSession, src: Sources, cfg: Config, out_dir: str | None = None,
        trees: int | None = None, draws: int | None = None, export_csv: bool = True,
        export_wide: bool = False) -> dict:
    """``trees`` and ``draws`` default to those of ``cfg``. ``export_wide`` adds the clean set with a 0/1
    column per level, for few levels only: their list comes to the driver. Returns the paths of what
    was written."""
    trees, draws = trees or cfg.trees, draws or cfg.draws
    out = (out_dir or f"{checkpoint_dir(spark).rstrip('/')}/pipeline").rstrip("/")
    paths: dict[str, str] = {}

    abt = files.materialize(for_export(build_abt(src, cfg)), f"{out}/abt")
    paths["abt"] = f"{out}/abt"
    bi = bi_view(abt, "dashboard_customer_first_order")
    if export_csv:
        paths["bi_extract"] = files.write_csv(bi, f"{out}/bi_extract_csv")

    cleaned = files.materialize(clean.clean_abt(abt, keep=(PERSON,), one_hot_columns=()), f"{out}/abt_clean")
    paths["abt_clean"] = f"{out}/abt_clean"
    if export_csv:
        paths["abt_clean_csv"] = files.write_csv(cleaned, f"{out}/abt_clean_csv")
        paths["one_hot_csv"] = files.write_csv(encode.one_hot_long(cleaned, PERSON, clean.CATEGORICAL), f"{out}/one_hot_csv")
    if export_csv and export_wide:
        paths["abt_wide_csv"] = files.write_csv(clean.clean_abt(abt), f"{out}/abt_wide_csv")

    flagged = model.keep_rows(split.stratified_split(cleaned, LABEL, PERSON, cfg.test_share, cfg.seed, folds=cfg.folds))
    categorical = list(clean.CATEGORICAL)
    numeric = model.feature_columns(flagged, LABEL, exclude=(PERSON, "is_test", "fold"))
    missing = model.missing_columns(flagged.where(F.col("is_test") == 0), numeric)
    prepared = model.prepare(flagged, LABEL, numeric, missing)
    numeric = model.with_indicators(numeric, missing)
    train = model.with_class_weight(prepared.where(F.col("is_test") == 0), LABEL)
    test = prepared.where(F.col("is_test") == 1)
    est = model.gbt(LABEL, max_iter=trees, seed=cfg.seed)
    best, search = model.tune(train, LABEL, numeric, est, model.param_draws(draws, cfg.seed),
                              parallelism=cfg.parallel_fits, prep=model.sparse_encoder(categorical, numeric))
    paths["search"] = files.write_parquet(search, f"{out}/search")
    features = model.sparse_feature_names(best, categorical, numeric)

    scores: DataFrame = files.materialize(model.score(best, test, [PERSON], LABEL), f"{out}/scores")
    paths["scores"] = f"{out}/scores"
    ranked = metrics.score_table(scores, "y_proba", PERSON).orderBy("rank")
    lift = metrics.lift_table(scores, "y_true", "y_proba", PERSON, cfg.deciles).orderBy("decile")
    paths["lift"] = files.write_parquet(lift, f"{out}/lift")
    paths["importance"] = files.write_parquet(model.feature_importance(best, features, spark), f"{out}/importance")
    if export_csv:
        paths["scores_csv"] = files.write_csv(ranked.select("y_true", "y_proba"), f"{out}/scores_csv")
        paths["lift_csv"] = files.write_csv(lift.coalesce(1), f"{out}/lift_csv")
    return paths
