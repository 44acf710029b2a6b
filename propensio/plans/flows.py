"""The five user actions as functions: data_prep, train, tune, evaluate, audit.

Steps talk through tables written to storage (the frozen table, saved
pipelines, JSON reports), as the reference's steps talk through files. Paths
are arguments; on a cluster they point to shared storage.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensio.config import DEFAULT_THRESHOLD, DataSpec, FeatureSpec
from propensio.operators import quality, splits
from propensio.operators.features import FeatureEngineer, FeatureModel
from propensio.operators.metrics import binary_metrics
from propensio.operators.models import PropensityModel, model_file_name
from propensio.session import cut_lineage
from propensio.sources.files import read_client_file, read_clients, read_table, write_json_rows

log = logging.getLogger(__name__)


@dataclass
class Settings:
    frozen_path: str
    artifacts_dir: str
    data: DataSpec = field(default_factory=DataSpec)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    family: str = "xgboost"
    params: dict = field(default_factory=dict)
    calibration: str = "isotonic"
    ensemble: bool = False
    threshold: float = DEFAULT_THRESHOLD
    tree_scale: float = 1.0
    parallelism: int = 2
    frozen_format: str = "parquet"
    use_tuned_params: bool = False  # train with the best trial of `tune` (the reference never reads it back)
    metrics_file: str | None = None  # optional one-file JSON copy of the evaluation metrics


# ---------------------------------------------------------------------------
# freeze (S7, S8, T1-T4, V1-V6)
# ---------------------------------------------------------------------------

def freeze(spark: SparkSession, source: DataFrame | str, settings: Settings, overwrite: bool = False) -> DataFrame:
    """Assign folds once and store the frozen table; reuse it unless overwrite."""
    spec = settings.data
    path = settings.frozen_path
    if not overwrite:
        try:
            existing = read_table(spark, path, settings.frozen_format)
            log.info("folds were assigned before, reading %s", path)
            return existing
        except FileNotFoundError:
            pass
    raw = read_clients(spark, source) if isinstance(source, str) else source
    quality.check_schema(raw, spec)
    quality.check_unique_ids(raw, spec.id_col)
    n_rows = raw.count()
    quality.check_min_rows(n_rows, spec)
    num, den, is_fraction = splits.test_fraction(spec)
    expected = -(-n_rows * num // den) if is_fraction else num
    if not 0 < expected < n_rows:
        raise ValueError(f"test_size={spec.test_size} gives {expected} test rows out of {n_rows}.")
    frozen = splits.assign_folds(raw, spec)
    writer = frozen.write.mode("overwrite").format(settings.frozen_format)
    if settings.frozen_format == "csv":
        writer = writer.option("header", True)
    if settings.frozen_format == "parquet":
        writer = writer.partitionBy(spec.fold_col)  # blocks and folds prune partitions
    writer.save(path)
    stored = read_table(spark, path, settings.frozen_format)
    quality.verify_split(stored, spec, expected)
    for row in quality.parity_report(stored, spec).collect():
        level = logging.INFO if row["ok"] else logging.WARNING
        log.log(level, "parity %s fold %s: rate=%.3f test=%.3f delta=%.4f", row["target"], row["fold"], row["rate"] or 0, row["test_rate"] or 0, row["delta"] or 0)
    return stored


def load_frozen(spark: SparkSession, settings: Settings) -> DataFrame:
    df = read_client_file(spark, settings.frozen_path, use_frozen=True, fmt=settings.frozen_format)
    quality.check_schema(df, settings.data, require_fold=True)
    quality.check_unique_ids(df, settings.data.id_col)
    return df


def fit_features(frozen: DataFrame, settings: Settings) -> FeatureModel:
    train = splits.train_val_block(frozen, settings.data).select(*settings.features.base_cols)
    return FeatureEngineer(quantileMethod=settings.features.quantile_method, accuracy=settings.features.quantile_accuracy).fit(train)


def xy_matrix(frozen: DataFrame, features: FeatureModel, target: str, settings: Settings) -> DataFrame:
    """ID, fold, features and ``label`` of ``target`` (other targets dropped)."""
    spec = settings.data
    if target not in frozen.columns:
        raise KeyError(f"no label column {target}")
    xy = frozen.select(spec.id_col, spec.fold_col, *[c for c in settings.features.base_cols if c in frozen.columns],
                       F.col(target).cast("int").alias("label"))
    return features.transform(xy)


# ---------------------------------------------------------------------------
# data_prep (3.1)
# ---------------------------------------------------------------------------

def data_prep(spark: SparkSession, source: DataFrame | str, settings: Settings, out_dir: str) -> dict:
    frozen = freeze(spark, source, settings)
    features = fit_features(frozen, settings)
    target = settings.data.primary_target
    fm = xy_matrix(frozen, features, target, settings)
    cols = [settings.data.id_col, *settings.features.feature_cols, F.col("label").alias(target)]
    train_path, test_path = f"{out_dir}/train_engineered", f"{out_dir}/test_engineered"
    splits.train_val_block(fm, settings.data).select(*cols).write.mode("overwrite").parquet(train_path)
    splits.test_block(fm, settings.data).select(*cols).write.mode("overwrite").parquet(test_path)
    features.write().overwrite().save(f"{out_dir}/feature_model")
    return {"train": train_path, "test": test_path, "stats": features.get_params()}


# ---------------------------------------------------------------------------
# train / evaluate (3.2)
# ---------------------------------------------------------------------------

def _model(settings: Settings, params: dict | None = None) -> PropensityModel:
    return PropensityModel(settings.family, params if params is not None else settings.params, settings.calibration,
                           settings.ensemble, settings.data.n_splits, settings.data.seed,
                           settings.features.feature_cols, settings.tree_scale, settings.parallelism)


def train(spark: SparkSession, settings: Settings) -> DataFrame:
    """Per target: fit features (once), fit + calibrate, evaluate on the blind set, save.

    Each saved model is one pipeline that starts with the fitted features, with a print of the frozen table, so
    training another family or freezing anew changes no stored model. Returns the performance report (target,
    metrics...) and writes it as JSON.
    """
    frozen = load_frozen(spark, settings)
    features, frozen_print = fit_features(frozen, settings), quality.table_print(frozen)
    reports = []
    tuned = tuned_params(spark, settings) if settings.use_tuned_params else {}
    for target in settings.data.target_cols:
        fm = xy_matrix(frozen, features, target, settings).persist()
        params = {**settings.params, **tuned.get(target, {})}
        model = _model(settings, params).fit(splits.train_val_block(fm, settings.data), id_col=settings.data.id_col)
        model.feature_model, model.frozen_print = features, frozen_print
        scored = model.predict_proba(splits.test_block(fm, settings.data))
        reports.append(cut_lineage(binary_metrics(scored, threshold=settings.threshold).select(F.lit(target).alias("target"), "*")))
        model.save(f"{settings.artifacts_dir}/{model_file_name(settings.family, target)}")
        fm.unpersist()
    perf = reports[0]
    for r in reports[1:]:
        perf = perf.unionByName(r)
    write_json_rows(perf, f"{settings.artifacts_dir}/{settings.family}_performance")
    return perf


def load_model(settings: Settings, target: str, frozen: DataFrame) -> PropensityModel:
    """The stored model of a target; says so when the frozen table isn't the one it was trained on."""
    model = PropensityModel.load(f"{settings.artifacts_dir}/{model_file_name(settings.family, target)}")
    if model.frozen_print != quality.table_print(frozen):
        log.warning("%s was trained on another frozen table than %s", model_file_name(settings.family, target), settings.frozen_path)
    return model


def tuned_params(spark: SparkSession, settings: Settings) -> dict[str, dict]:
    """Best trial parameters per target, as written by ``tune``."""
    import json

    path = f"{settings.artifacts_dir}/{settings.family}_best_params"
    rows = spark.read.json(path).select("target", "params").collect()  # one row per target
    return {r["target"]: json.loads(r["params"]) for r in rows}


def evaluate(spark: SparkSession, settings: Settings, target: str | None = None) -> DataFrame:
    """Score the blind test block with a stored model and the features stored in it; nothing is refitted."""
    target = target or settings.data.primary_target
    frozen = load_frozen(spark, settings)
    model = load_model(settings, target, frozen)
    scored = model.score_clients(splits.test_block(frozen, settings.data)).withColumn("label", F.col(target).cast("int"))
    metrics = binary_metrics(scored, threshold=settings.threshold)
    write_json_rows(metrics, f"{settings.artifacts_dir}/evaluation_metrics", local_copy=settings.metrics_file)
    return metrics


# ---------------------------------------------------------------------------
# tune (3.3)
# ---------------------------------------------------------------------------

def tune(spark: SparkSession, settings: Settings, n_trials: int | None = None, timeout_seconds: float | None = None,
         refit_features_per_fold: bool = False) -> DataFrame:
    """Random search per target. Features are fitted once on all train/val rows
    (as the reference does) unless ``refit_features_per_fold`` (honest CV)."""
    from propensio.operators.tuning import best_trials, random_search, trials_frame

    frozen = load_frozen(spark, settings)
    features = fit_features(frozen, settings)
    engineer = FeatureEngineer(quantileMethod=settings.features.quantile_method,
                               accuracy=settings.features.quantile_accuracy)
    spec = settings.data
    frames = []
    for target in settings.data.target_cols:
        if refit_features_per_fold:
            fm = splits.train_val_block(frozen, spec).select(
                spec.id_col, *settings.features.base_cols, F.col(target).cast("int").alias("label"))
        else:
            fm = splits.train_val_block(xy_matrix(frozen, features, target, settings), spec)
        results = random_search(fm, settings.family, n_trials, settings.data.seed, settings.data.n_splits,
                                settings.data.id_col, timeout_seconds=timeout_seconds,
                                parallelism=settings.parallelism, tree_scale=settings.tree_scale,
                                features=settings.features.feature_cols,
                                feature_engineer=engineer if refit_features_per_fold else None)
        frames.append(trials_frame(spark, target, results))
    trials = frames[0]
    for f in frames[1:]:
        trials = trials.unionByName(f)
    trials.write.mode("overwrite").parquet(f"{settings.artifacts_dir}/{settings.family}_trials")
    best = best_trials(spark.read.parquet(f"{settings.artifacts_dir}/{settings.family}_trials"))
    write_json_rows(best, f"{settings.artifacts_dir}/{settings.family}_best_params")
    return best


# ---------------------------------------------------------------------------
# audit (3.3)
# ---------------------------------------------------------------------------

def audit(spark: SparkSession, settings: Settings, n_counterfactuals: int = 3, n_candidates: int = 200,
          n_queries: int | None = None, target: str | None = None) -> dict[str, DataFrame]:
    """Global explanation of the stored model and counterfactuals for rejected clients.

    Clients without a counterfactual after the last round are in ``counterfactuals_open``. For the additive
    family the shape table of every term is written too (``shapes``).
    ``n_queries`` None explains every rejected client (the reference takes 2).
    """
    from propensio.operators import counterfactuals as cf
    from propensio.operators.explain import additive_model, explain_global

    spec = settings.data
    target = target or spec.primary_target
    frozen = load_frozen(spark, settings)
    model = load_model(settings, target, frozen)
    features = model.feature_model
    test_fm = xy_matrix(splits.test_block(frozen, spec), features, target, settings)
    explanation = explain_global(model, test_fm)
    ranges = cf.training_ranges(splits.train_val_block(frozen, spec))
    scored = model.predict_proba(test_fm)
    rejected_ids = scored.where(F.col("score") < settings.threshold).select(spec.id_col)
    if n_queries is not None:
        rejected_ids = rejected_ids.orderBy(spec.id_col).limit(n_queries)
    queries = splits.test_block(frozen, spec).join(rejected_ids, spec.id_col, "left_semi").select(
        spec.id_col, *settings.features.base_cols, F.lit(0).alias("orig_prediction"))

    def score_fn(cand: DataFrame) -> DataFrame:
        return cf.score_keeping_inputs(cand, lambda d: model.predict_proba(features.transform(d)),
                                       list(settings.features.base_cols))

    best = cf.generate_complete(queries, ranges, score_fn, k=n_counterfactuals, n_candidates=n_candidates,
                                seed=spec.seed, id_col=spec.id_col, threshold=settings.threshold)
    open_clients = best.where("n_found = 0").select(spec.id_col, "n_found", "n_drawn")
    open_clients.write.mode("overwrite").json(f"{settings.artifacts_dir}/counterfactuals_open")
    out = best.where("n_found > 0").select(spec.id_col, "cf_rank", "cand", *cf.FEATURES_TO_VARY, "n_changed", "distance", "score")
    out.write.mode("overwrite").json(f"{settings.artifacts_dir}/counterfactuals")
    if explanation is not None:  # S16: the table behind the plot
        explanation.write.mode("overwrite").parquet(f"{settings.artifacts_dir}/explanation_{settings.family}")
    result = {}
    if settings.family == "ebm":
        result["shapes"] = additive_model(model.base_model()).shape_table(spark)
        result["shapes"].write.mode("overwrite").parquet(f"{settings.artifacts_dir}/shapes_{settings.family}")
    return result | {"explanation": explanation, "counterfactuals": out, "counterfactuals_open": open_clients}


ACTIONS = ("data_prep", "train", "tune", "evaluate", "audit")


def run_action(action: str, spark: SparkSession, settings: Settings, **kwargs):
    """Dispatch one of the five actions by name (V9: unknown → ValueError)."""
    table = {"data_prep": data_prep, "train": train, "tune": tune, "evaluate": evaluate, "audit": audit}
    if action not in table:
        raise ValueError(f"{action!r} is none of {', '.join(ACTIONS)}")
    if action == "data_prep":
        return data_prep(spark, kwargs.pop("source"), settings, kwargs.pop("out_dir"), **kwargs)
    return table[action](spark, settings, **kwargs)
