"""Registered queries: one DataFrame plan per operator, over the driver tables.

Every query starts from ``clients_view`` (customer + orders), so its work grows
with the tables. Double columns of reports are rounded to 6 places (metrics to
4, like the reference) so that engines summing in another order still agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensio.config import DataSpec, FeatureSpec
from propensio.operators import quality, splits
from propensio.operators.features import FeatureEngineer, FeatureModel
from propensio.session import cut_lineage
from propensio.session import materialize as materialize_table
from propensio.session import write_work_table
from propensio.sources.tables import clients_view, read_driver_table

SPEC = DataSpec()
FSPEC = FeatureSpec()
REPORT_DIGITS = 6


# Doubles at or above this magnitude are reported as they are: their ulp is
# already close to 1e-6, and SQL engines that round via x·10^d lose it there.
BIG = 1e9


def round_doubles(df: DataFrame, digits: int = REPORT_DIGITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.abs(c) >= BIG, c).otherwise(F.round(c, digits)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def folded(spark: SparkSession, sf_dir: str, spec: DataSpec = SPEC, materialize: bool = True) -> DataFrame:
    """The frozen client table (folds assigned).

    Like the reference's frozen file, it is written once (Parquet partitioned
    by fold, in the session's shared checkpoint folder), so the fits and
    reports that follow read it, with the fold filter pruning partitions.
    """
    if not materialize:
        return splits.assign_folds(clients_view(spark, sf_dir), spec)
    key = _artifact_key(spark, sf_dir, spec)
    if key in _FROZEN:  # freeze once per application (the reference's skip-if-frozen)
        return spark.read.parquet(_FROZEN[key])
    # the view is written first: the fold plan reads its input twice (bucket
    # counts, then ranks), and re-aggregating all orders twice costs more
    clients = materialize_table(clients_view(spark, sf_dir), "clients")
    _FROZEN[key] = write_work_table(splits.assign_folds(clients, spec), "frozen", [spec.fold_col])
    return spark.read.parquet(_FROZEN[key])


# Artifacts made once per Spark application and source: the frozen table and
# the feature model fitted on its train block (steps read them, never refit).
_FROZEN: dict = {}
_FEATURES: dict = {}


def _artifact_key(spark: SparkSession, sf_dir: str, spec: DataSpec) -> tuple:
    """Application, table files (a rewritten table has others) and settings."""
    files = tuple(sorted(f for t in ("customer", "orders") for f in read_driver_table(spark, sf_dir, t).inputFiles()))
    return (spark.sparkContext.applicationId, files, spec)


def fitted_features(spark: SparkSession, sf_dir: str, spec: DataSpec = SPEC) -> tuple[DataFrame, FeatureModel]:
    """Frozen table and the feature model fitted on its train/val block."""
    frame = folded(spark, sf_dir, spec)
    key = _artifact_key(spark, sf_dir, spec)
    if key not in _FEATURES:  # fitted once per frozen table, like a saved feature model
        train = splits.train_val_block(frame, spec).select(*FSPEC.base_cols)
        _FEATURES[key] = FeatureEngineer(quantileMethod=FSPEC.quantile_method, accuracy=FSPEC.quantile_accuracy).fit(train)
    return frame, _FEATURES[key]


def feature_matrix(spark: SparkSession, sf_dir: str, target: str | None = None, spec: DataSpec = SPEC) -> tuple[DataFrame, FeatureModel]:
    """ID, fold, 16 features and label of every row (features fitted on train)."""
    frame, model = fitted_features(spark, sf_dir, spec)
    target = target or spec.primary_target
    xy = frame.select(spec.id_col, spec.fold_col, *FSPEC.base_cols, F.col(target).cast("int").alias("label"))
    return model.transform(xy), model


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def q_clients_view(spark, sf_dir):
    return clients_view(spark, sf_dir)


def q_typed_csv_clients(spark, sf_dir):
    """The client table written as CSV with a header and read back with declared types."""
    from propensio.session import work_dir
    from propensio.sources.files import read_clients

    clients = clients_view(spark, sf_dir)
    path = work_dir(spark, f"clients-{uuid.uuid4().hex}.csv")
    clients.select(*reversed(clients.columns)).write.option("header", True).csv(path)
    return read_clients(spark, path, schema=clients.schema).select(*clients.columns)


def q_label_folds(spark, sf_dir):
    """T5: stratified folds on one label over the train/val block (trial scoring and calibration)."""
    tv = splits.split_xy(splits.train_val_block(folded(spark, sf_dir)), SPEC.primary_target)
    return splits.assign_label_folds(tv, "label", SPEC.n_splits, SPEC.seed, SPEC.id_col).select(SPEC.id_col, "label", F.col("_cv_fold").alias("fold"))


def q_freeze_folds(spark, sf_dir):
    return folded(spark, sf_dir, materialize=False)


def q_fold_counts(spark, sf_dir):
    return quality.fold_counts(folded(spark, sf_dir))


def q_split_counts(spark, sf_dir):
    return quality.split_counts(folded(spark, sf_dir))


def q_parity_report(spark, sf_dir):
    return round_doubles(quality.parity_report(folded(spark, sf_dir)))


def q_duplicate_ids(spark, sf_dir):
    return quality.id_report(clients_view(spark, sf_dir))


def q_train_block(spark, sf_dir):
    return splits.split_xy(splits.train_val_block(folded(spark, sf_dir)), SPEC.primary_target)


def q_test_block(spark, sf_dir):
    return splits.split_xy(splits.test_block(folded(spark, sf_dir)), SPEC.primary_target)


def q_cv_fold_2(spark, sf_dir):
    train, val = splits.cv_fold(folded(spark, sf_dir), 2)
    pick = lambda d, role: splits.split_xy(d, SPEC.primary_target).select(
        SPEC.id_col, F.lit(role).alias("role"), "label"
    )
    return pick(train, "train").unionByName(pick(val, "val"))


def q_fitted_stats(spark, sf_dir):
    _, model = fitted_features(spark, sf_dir)
    st = model.get_params()
    row = {f"med_{c}": st["medians"].get(c) for c in FSPEC.base_cols}
    row.update(p99_inc=st["p99_inc"], p99_wth=st["p99_wth"], inc_max=st["inc_max"])
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in row])
    return round_doubles(spark.createDataFrame([tuple(float(v) if v is not None else None for v in row.values())], schema))


def q_feature_matrix_train(spark, sf_dir):
    fm, _ = feature_matrix(spark, sf_dir)
    return round_doubles(splits.train_val_block(fm).drop(SPEC.fold_col))


def q_feature_matrix_test(spark, sf_dir):
    fm, _ = feature_matrix(spark, sf_dir)
    return round_doubles(splits.test_block(fm).drop(SPEC.fold_col))


def q_age_brackets(spark, sf_dir):
    from propensio.functions.features import age_bracket_flags

    c = clients_view(spark, sf_dir)
    flags = age_bracket_flags(F.col("Age"))
    return c.select("ID", "Age", *[e.alias(n) for n, e in flags.items()])


def both_label_matrix(spark, sf_dir) -> DataFrame:
    frame, model = fitted_features(spark, sf_dir)
    xy = frame.select(SPEC.id_col, SPEC.fold_col, *FSPEC.base_cols, *SPEC.target_cols)
    return model.transform(xy)


def long_by_target(fm: DataFrame, score) -> DataFrame:
    """(target, ID, fold, score, label): one row per client and target."""
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("int").alias("label")) for t in SPEC.target_cols])
    return fm.select(SPEC.id_col, SPEC.fold_col, score.alias("score"), F.explode(pairs).alias("_t")).select(
        "_t.target", SPEC.id_col, SPEC.fold_col, "score", "_t.label"
    )


def q_metrics_by_target(spark, sf_dir):
    from propensio.functions.scores import probe_score
    from propensio.operators.metrics import binary_metrics

    scored = long_by_target(splits.test_block(both_label_matrix(spark, sf_dir)), probe_score())
    return binary_metrics(scored, group_cols=["target"])


def q_auc_by_fold(spark, sf_dir):
    from propensio.functions.scores import probe_score
    from propensio.operators.metrics import binary_metrics

    fm, _ = feature_matrix(spark, sf_dir)
    scored = splits.train_val_block(fm).select(F.col(SPEC.fold_col).alias("fold"), probe_score().alias("score"), "label")
    return binary_metrics(scored, group_cols=["fold"])


def q_minmax_scaled(spark, sf_dir):
    from propensio.operators.scaling import MinMaxColumns

    fm, _ = feature_matrix(spark, sf_dir)
    feats = FSPEC.feature_cols
    scaler = MinMaxColumns(inputCols=feats).fit(splits.train_val_block(fm))
    scaled = scaler.transform(splits.test_block(fm)).drop(SPEC.fold_col)
    return round_doubles(scaled)


def q_isotonic_calibration(spark, sf_dir):
    """Isotonic fit of the probe score (2 places) on the train/val block."""
    from propensio.functions.scores import probe_score
    from propensio.operators.calibration import fit_isotonic, isotonic_points

    fm, _ = feature_matrix(spark, sf_dir)
    oof = splits.train_val_block(fm).select(F.round(probe_score(), 2).alias("raw_score"), "label")
    iso = fit_isotonic(oof)
    points = isotonic_points(oof).select("raw_score")
    return round_doubles(iso.transform(points).select("raw_score", "score"))


def q_isotonic_calibration_unrounded(spark, sf_dir):
    """Isotonic fit as the trainer calls it: the probability before any rounding, every distinct score (reported rounded)."""
    from propensio.functions.scores import probe_logit
    from propensio.operators.calibration import fit_isotonic, isotonic_points

    fm, _ = feature_matrix(spark, sf_dir)
    oof = splits.train_val_block(fm).select((F.lit(1.0) / (F.lit(1.0) + F.exp(-probe_logit()))).alias("raw_score"), "label")
    iso = fit_isotonic(oof)
    return round_doubles(iso.transform(isotonic_points(oof).select("raw_score")).select("raw_score", "score"))


def probe_scored_test(spark, sf_dir):
    """Blind-block clients with their raw base columns and the probe score."""
    from propensio.functions.scores import probe_score

    frame, model = fitted_features(spark, sf_dir)
    raw = [F.col(c).alias(f"raw__{c}") for c in FSPEC.base_cols]
    test = splits.test_block(frame).select(SPEC.id_col, *FSPEC.base_cols, *raw)
    scored = model.transform(test).withColumn("score", probe_score())
    scored = scored.select(SPEC.id_col, *[F.col(f"raw__{c}").alias(c) for c in FSPEC.base_cols], "score")
    return frame, model, scored


def q_rejected_clients(spark, sf_dir):
    """P10: test-block clients whose (probe) score is below the threshold."""
    _, _, scored = probe_scored_test(spark, sf_dir)
    return scored.where(F.col("score") < 0.5).select(SPEC.id_col, *FSPEC.base_cols, "score")


def q_hard_predictions(spark, sf_dir):
    """Score ≥ threshold → 1 on the blind block, per client."""
    from propensio.operators.metrics import hard_prediction

    _, _, scored = probe_scored_test(spark, sf_dir)
    return scored.select(SPEC.id_col, "score", hard_prediction(F.col("score"), 0.5).alias("prediction"))


def _cf_pieces(spark, sf_dir):
    from propensio.functions.scores import probe_score
    from propensio.operators import counterfactuals as cf

    frame, model, scored = probe_scored_test(spark, sf_dir)
    ranges = cf.training_ranges(splits.train_val_block(frame))
    rejected = scored.where(F.col("score") < 0.5).select(
        SPEC.id_col, *FSPEC.base_cols, (F.col("score") >= 0.5).cast("int").alias("orig_prediction")
    )
    base = list(FSPEC.base_cols)

    def score_fn(cand: DataFrame) -> DataFrame:
        return cf.score_keeping_inputs(cand, lambda d: model.transform(d).withColumn("score", probe_score()), base)

    return cf, ranges, rejected, score_fn, base


def q_cf_candidates(spark, sf_dir):
    """X7 + X8: every candidate of every rejected client that flips the class."""
    cf, ranges, rejected, score_fn, base = _cf_pieces(spark, sf_dir)
    cand = cf.candidates(rejected, ranges, n_candidates=CF_CANDIDATES)
    scored = score_fn(cand).where(F.col("score") >= 0.5)
    return round_doubles(scored.select(SPEC.id_col, "cand", *cf.FEATURES_TO_VARY, "n_changed", "distance", "score"))


def q_counterfactuals(spark, sf_dir):
    """Best 3 counterfactuals per rejected client with a flip in one round (the SQL twin's rule)."""
    cf, ranges, rejected, score_fn, base = _cf_pieces(spark, sf_dir)
    best = cf.generate(rejected, ranges, score_fn, k=3, n_candidates=CF_CANDIDATES)
    return round_doubles(best.select(SPEC.id_col, "cf_rank", "cand", *cf.FEATURES_TO_VARY, "n_changed", "distance", "score"))


def q_counterfactuals_complete(spark, sf_dir):
    """Every rejected client, further rounds for those without a flip, open ones with n_found = 0."""
    cf, ranges, rejected, score_fn, base = _cf_pieces(spark, sf_dir)
    return round_doubles(cf.generate_complete(rejected, ranges, score_fn, k=3, n_candidates=CF_CANDIDATES))


CF_CANDIDATES = 200

ENGINEERED = list(FSPEC.engineered_cols)


def q_pairwise_features(spark, sf_dir):
    """D1 on the imputed base columns of the blind test block."""
    from propensio.operators.synthesis import pairwise_exprs

    fm, _ = feature_matrix(spark, sf_dir)
    exprs = pairwise_exprs(list(FSPEC.base_cols))
    return round_doubles(splits.test_block(fm).select(SPEC.id_col, *[e.alias(n) for n, e in exprs.items()]))


def q_percentile_feature(spark, sf_dir):
    """Percentile rank of imputed Income and Wealth inside the train block."""
    from propensio.operators.synthesis import percentile_rank

    fm, _ = feature_matrix(spark, sf_dir)
    tv = splits.train_val_block(fm).select(SPEC.id_col, "Income", "Wealth")
    out = percentile_rank(percentile_rank(tv, "Income"), "Wealth")
    return round_doubles(out.select(SPEC.id_col, "Income_percentile", "Wealth_percentile"))


def q_corr_dedup(spark, sf_dir):
    """Generated pairwise features against the 9 engineered ones (train block)."""
    from propensio.operators.synthesis import correlation_filter, pairwise_exprs

    fm, _ = feature_matrix(spark, sf_dir)
    exprs = pairwise_exprs(list(FSPEC.base_cols))
    tv = splits.train_val_block(fm).select(*ENGINEERED, *[e.alias(n) for n, e in exprs.items()])
    return round_doubles(correlation_filter(tv, list(exprs), ENGINEERED))


def _both_targets(spark, sf_dir, family: str, calibration: str = "isotonic"):
    from concurrent.futures import ThreadPoolExecutor

    from propensio.operators.metrics import binary_metrics
    from propensio.operators.models import PropensityModel

    # written by fold, so the blocks read their own files; a fit deals its rows over as many tasks as they fill
    fm = materialize_table(both_label_matrix(spark, sf_dir), "training-matrix", [SPEC.fold_col])

    def one(target):
        data = fm.withColumn("label", F.col(target).cast("int"))
        model = PropensityModel(family, calibration=calibration, parallelism=6)
        model.fit(splits.train_val_block(data))
        scored = model.predict_proba(splits.test_block(data))
        return binary_metrics(scored).select(F.lit(target).alias("target"), F.lit(family).alias("family"), "*")

    with ThreadPoolExecutor(max_workers=2) as pool:
        frames = list(pool.map(one, SPEC.target_cols))
    return frames[0].unionByName(frames[1])


def _train_query(family: str):
    def q(spark, sf_dir):
        return _both_targets(spark, sf_dir, family)

    q.__name__ = f"q_train_{family}"
    q.__doc__ = f"M1-M15: calibrated {family} per target, metrics on the blind test block."
    return q


def q_tuned_random_forest(spark, sf_dir):
    """Seeded random search for the forest, every configured trial on both targets."""
    from propensio.operators.tuning import best_trials, random_search, trials_frame

    tv = materialize_table(splits.train_val_block(both_label_matrix(spark, sf_dir)), "training-matrix")
    trials = None
    for target in SPEC.target_cols:
        results = random_search(tv.withColumn("label", F.col(target).cast("int")), "random_forest", parallelism=8)
        part = trials_frame(spark, target, results)
        trials = part if trials is None else trials.unionByName(part)
    best = best_trials(trials).select("target", F.col("trial").alias("best_trial"))
    return trials.join(best, "target").select("*", (F.col("trial") == F.col("best_trial")).alias("is_best")).drop("best_trial")


def _explained_model(spark, sf_dir, family):
    from propensio.operators.models import PropensityModel

    fm, _ = feature_matrix(spark, sf_dir)
    fm = materialize_table(fm, "training-matrix", [SPEC.fold_col])
    model = PropensityModel(family, calibration="none").fit(splits.train_val_block(fm))
    return fm, model


def q_shap_summary(spark, sf_dir):
    """TreeSHAP of the boosted-tree family on the blind test block."""
    from propensio.operators.explain import explain_global

    fm, model = _explained_model(spark, sf_dir, "xgboost")
    return explain_global(model, splits.test_block(fm))


def q_additive_terms(spark, sf_dir):
    """Per-feature importance of the additive family."""
    from propensio.operators.explain import explain_global

    fm, model = _explained_model(spark, sf_dir, "ebm")
    return explain_global(model, splits.test_block(fm))


def q_additive_shapes(spark, sf_dir):
    """Centred shape function of every term of the additive family."""
    from propensio.operators.explain import additive_model

    _, model = _explained_model(spark, sf_dir, "ebm")
    return additive_model(model.base_model()).shape_table(spark)


def q_top_features(spark, sf_dir):
    """D3/L4: top 15 generated features by boosted-tree importance, the engineered ones competing in the trees."""
    from pyspark.ml import Pipeline

    from propensio.operators.models import base_stages, sized_for_fitting
    from propensio.operators.synthesis import MISSING, pairwise_exprs, top_features

    fm, _ = feature_matrix(spark, sf_dir)
    exprs = pairwise_exprs(list(FSPEC.base_cols))
    names = FSPEC.feature_cols + list(exprs)
    tv = splits.train_val_block(fm).select(
        SPEC.id_col, "label", *FSPEC.feature_cols, *[F.coalesce(e, F.lit(MISSING)).alias(n) for n, e in exprs.items()])
    tv = sized_for_fitting(tv.withColumn("label", F.col("label").cast("double")), SPEC.id_col).persist()
    gbt = Pipeline(stages=base_stages("xgboost", features=names)).fit(tv).stages[-1]
    tv.unpersist()
    imp = gbt.importances()
    rows = [(i + 1, n, float(v)) for i, (n, v) in enumerate(top_features({n: imp[n] for n in exprs}, 15))]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def q_boruta_selection(spark, sf_dir):
    """Boruta-style confirmation of the 16 features, at most 100 rounds, each feature until it is decided."""
    from propensio.operators.synthesis import boruta

    fm, _ = feature_matrix(spark, sf_dir)
    tv = cut_lineage(splits.train_val_block(fm))
    return boruta(tv, FSPEC.feature_cols, rounds=100, n_trees=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clients_view": q_clients_view,
    "typed_csv_clients": q_typed_csv_clients,
    "label_folds": q_label_folds,
    "freeze_folds": q_freeze_folds,
    "fold_counts": q_fold_counts,
    "split_counts": q_split_counts,
    "parity_report": q_parity_report,
    "duplicate_ids": q_duplicate_ids,
    "train_block": q_train_block,
    "test_block": q_test_block,
    "cv_fold_2": q_cv_fold_2,
    "fitted_stats": q_fitted_stats,
    "feature_matrix_train": q_feature_matrix_train,
    "feature_matrix_test": q_feature_matrix_test,
    "age_brackets": q_age_brackets,
    "metrics_by_target": q_metrics_by_target,
    "auc_by_fold": q_auc_by_fold,
    "minmax_scaled": q_minmax_scaled,
    "isotonic_calibration": q_isotonic_calibration,
    "isotonic_calibration_unrounded": q_isotonic_calibration_unrounded,
    "rejected_clients": q_rejected_clients,
    "hard_predictions": q_hard_predictions,
    "cf_candidates": q_cf_candidates,
    "counterfactuals": q_counterfactuals,
    "counterfactuals_complete": q_counterfactuals_complete,
    "pairwise_features": q_pairwise_features,
    "percentile_feature": q_percentile_feature,
    "corr_dedup": q_corr_dedup,
    **{f"train_{fam}": _train_query(fam) for fam in ("xgboost", "lightgbm", "catboost", "random_forest", "ebm", "tabnet")},
    "tuned_random_forest": q_tuned_random_forest,
    "shap_summary": q_shap_summary,
    "additive_terms": q_additive_terms,
    "additive_shapes": q_additive_shapes,
    "top_features": q_top_features,
    "boruta_selection": q_boruta_selection,
}
