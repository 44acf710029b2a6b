"""Model explanations.

* Tree families: exact path-dependent TreeSHAP (Lundberg et al., 2018/2020)
  per row and feature. The trees are read back from the saved Spark ML model
  (its node table is Parquet) and packed in chunks that meet blocks of rows. Contributions add up
  to the model margin (GBT) or the class-1 probability (random forest).
* Additive (EBM-like) family: the fitted, centred score of each feature bin is
  that feature's contribution; the shape table lists them, the per-term
  importance is the mean absolute contribution over the rows.
* Summary (X5): per feature, mean |contribution|, value range and the
  correlation of value and contribution, from one grouped aggregate.
"""

from __future__ import annotations

import logging
import pickle
import uuid

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensio.operators.additive import AdditiveModel
from propensio.operators.boosting import BoostedTreesModel
from propensio.operators.forest import ForestModel
from propensio.session import materialize, work_dir

log = logging.getLogger(__name__)

TREE_FAMILIES = ("xgboost", "lightgbm", "catboost", "random_forest")


# ---------------------------------------------------------------------------
# tree tables
# ---------------------------------------------------------------------------

def _tree_of(nodes: pd.DataFrame, weight: float, forest: bool) -> dict:
    """Flat arrays of one tree: left, right, feature, threshold, value, cover, weight."""
    nodes = nodes.sort_values("id")
    left, right = nodes["leftChild"].to_numpy(np.int64), nodes["rightChild"].to_numpy(np.int64)
    inner = left >= 0
    thr = np.array([t[0] if k else 0.0 for t, k in zip(nodes["threshold"], inner)], dtype=float)
    stats = [np.asarray(s if s is not None else [], dtype=float) for s in nodes["impurityStats"]]
    raw = nodes["rawCount"].to_numpy(float)
    if forest:
        total = np.array([s.sum() for s in stats])
        value = np.array([s[1] / t if t > 0 and len(s) > 1 else 0.0 for s, t in zip(stats, total)])
        cover = np.where(total > 0, total, raw)
    else:
        value, cover = nodes["prediction"].to_numpy(float), raw
    feature = np.where(inner, nodes["feature"].to_numpy(np.int64), -1)
    return {"left": left, "right": right, "feature": feature, "threshold": thr, "value": value, "cover": cover, "weight": weight}


def node_table(spark: SparkSession, tree_model) -> DataFrame:
    """The saved model's nodes: ``tree, id, prediction, impurityStats, rawCount, leftChild, rightChild, feature, threshold``."""
    if isinstance(tree_model, (BoostedTreesModel, ForestModel)):
        return tree_model.node_rows(spark)
    path = work_dir(spark, f"trees-{uuid.uuid4().hex}")
    tree_model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"), F.col("nodeData.split.leftCategoriesOrThreshold").alias("threshold"),
    )


def tree_weights(tree_model) -> list[float]:
    if isinstance(tree_model, BoostedTreesModel):
        return [1.0] * tree_model.num_trees
    if isinstance(tree_model, ForestModel):
        return [1.0 / tree_model.num_trees] * tree_model.num_trees
    weights = [float(w) for w in tree_model.treeWeights]
    return [w / len(weights) for w in weights] if isinstance(tree_model, RandomForestClassificationModel) else weights


def tree_tables(spark: SparkSession, tree_model) -> list[dict]:
    """Flat arrays of every tree on the driver (for small models and tests; ``shap_values`` never collects them)."""
    weights, forest = tree_weights(tree_model), isinstance(tree_model, RandomForestClassificationModel)
    nodes = node_table(spark, tree_model).toPandas()
    return [_tree_of(part, weights[tree], forest) for tree, part in sorted(nodes.groupby("tree"), key=lambda x: x[0])]


def tree_chunks(nodes: DataFrame, most: int) -> list[tuple[int, int]]:
    """(tree, chunk): consecutive trees of together at most ``most`` nodes, or one larger tree. One row a tree reaches the driver."""
    out, chunk, held = [], 0, 0
    for r in nodes.groupBy("tree").count().orderBy("tree").collect():
        if held and held + r["count"] > most:
            chunk, held = chunk + 1, 0
        held += r["count"]
        out.append((r["tree"], chunk))
    return out


# ---------------------------------------------------------------------------
# path-dependent TreeSHAP, vectorised over the rows of a batch
# ---------------------------------------------------------------------------
# The algorithm walks every root-to-leaf path once. Along a path, the feature
# (d) and the "zero" fraction (z, a cover ratio) do not depend on the row;
# only the "one" fraction (o: does the row follow this branch) and the
# permutation weights (w) do. So d, z are scalars and o, w are arrays over
# the rows of the batch: one traversal per tree and batch, numpy per step.

def _extend(path, pz, po, pi, n):
    d, z, o, w = path
    length = len(d)
    d, z, o, w = d + [pi], z + [pz], o + [po], w + [np.ones(n) if length == 0 else np.zeros(n)]
    for i in range(length - 1, -1, -1):
        w[i + 1] = w[i + 1] + po * w[i] * ((i + 1) / (length + 1))
        w[i] = pz * w[i] * ((length - i) / (length + 1))
    return d, z, o, w


def _unwind_weights(path, i):
    d, z, o, w = path
    last = len(d) - 1
    n_acc = w[last]
    oi, zi = o[i], z[i]
    one = oi != 0
    safe_o = np.where(one, oi, 1.0)
    out = list(w)
    with np.errstate(divide="ignore", invalid="ignore"):
        for j in range(last - 1, -1, -1):
            t = out[j]
            w_one = n_acc * (last + 1) / ((j + 1) * safe_o)
            w_zero = t * (last + 1) / (zi * (last - j)) if zi != 0 else np.zeros_like(t)
            n_acc = np.where(one, t - w_one * zi * ((last - j) / (last + 1)), n_acc)
            out[j] = np.where(one, w_one, w_zero)
    return out[:-1]


def _unwind(path, i):
    d, z, o, _w = path
    w = _unwind_weights(path, i)
    d = d[:i] + d[i + 1:]
    z = z[:i] + z[i + 1:]
    o = o[:i] + o[i + 1:]
    return d, z, o, w


def tree_shap_batch(X: np.ndarray, tree: dict, phi: np.ndarray) -> None:
    """Add one tree's SHAP values of every row of X (n × m) into phi (n × m)."""
    left, right, feat = tree["left"], tree["right"], tree["feature"]
    thr, value, cover, weight = tree["threshold"], tree["value"], tree["cover"], tree["weight"]
    n = X.shape[0]

    def recurse(j, path, pz, po, pi):
        path = _extend(path, pz, po, pi, n)
        if left[j] < 0:
            d, z, o, _w = path
            for i in range(1, len(d)):
                total = sum(_unwind_weights(path, i))
                phi[:, d[i]] += weight * value[j] * total * (o[i] - z[i])
            return
        f = feat[j]
        xv = X[:, f]
        goes_left = (~np.isnan(xv)) & (xv <= thr[j])
        iz, io = 1.0, np.ones(n)
        d = path[0]
        k = next((i for i in range(1, len(d)) if d[i] == f), None)
        if k is not None:
            iz, io = path[1][k], path[2][k]
            path = _unwind(path, k)
        cj = cover[j] if cover[j] > 0 else 1.0
        recurse(left[j], path, iz * cover[left[j]] / cj, io * goes_left, f)
        recurse(right[j], path, iz * cover[right[j]] / cj, io * ~goes_left, f)

    recurse(0, ([], [], [], []), 1.0, np.ones(n), -1)


def expected_value(trees: list[dict]) -> float:
    total = 0.0
    for t in trees:
        leaves = t["left"] < 0
        total += t["weight"] * float(np.sum(t["value"][leaves] * t["cover"][leaves]) / t["cover"][0])
    return total


def model_output(x: np.ndarray, trees: list[dict]) -> float:
    """Margin (GBT) or class-1 probability (forest) of one row, from the tables."""
    total = 0.0
    for t in trees:
        j = 0
        while t["left"][j] >= 0:
            xv = x[t["feature"][j]]
            j = t["left"][j] if (not np.isnan(xv) and xv <= t["threshold"][j]) else t["right"][j]
        total += t["weight"] * t["value"][j]
    return total


def ship_by_value() -> None:
    """Send this module's functions to the Python workers with the task.

    Workers then need numpy/pandas only, not this package on their path.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Most rows of a block and most nodes of a chunk of trees: a task holds one of each.
SHAP_ROWS, SHAP_NODES = 65_536, 200_000
_BATCH = 4096  # rows that walk a tree at once


def _pack_rows(names: list[str]):
    """The rows of a partition as one block: its number, the row keys, the values as one matrix."""

    def run(batches):
        from pyspark import TaskContext

        parts = [pdf for pdf in batches if len(pdf)]
        if parts:
            rows = pd.concat(parts)
            x = rows[names].to_numpy(dtype=float, na_value=np.nan)
            yield pd.DataFrame({"block": [TaskContext.get().partitionId()], "keys": [rows["key"].tolist()], "x": [x.astype("<f8").tobytes()]})

    return run


def _pack_trees(weights: list[float], forest: bool):
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        trees = [_tree_of(part, weights[int(tree)], forest) for tree, part in nodes.groupby("tree")]
        return pd.DataFrame({"chunk": [nodes["chunk"].iloc[0]], "trees": [pickle.dumps(trees)]})

    return run


def _explain_block(m: int):
    def run(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        """Contributions of one chunk of trees to one block of rows, as one matrix."""
        if not len(rows) or not len(trees):
            return pd.DataFrame({"block": [], "phi": []})
        x = np.frombuffer(rows["x"].iloc[0], "<f8").reshape(-1, m)
        phi = np.zeros(x.shape)
        for tree in pickle.loads(trees["trees"].iloc[0]):
            for at in range(0, len(x), _BATCH):
                tree_shap_batch(x[at : at + _BATCH], tree, phi[at : at + _BATCH])
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "phi": [phi.astype("<f8").tobytes()]})

    return run


def _sum_chunks(batches):
    """Sum of the matrices of a block; a partition holds whole blocks, in order, so one running sum is kept."""
    block, total = None, None
    for pdf in batches:
        for b, raw in zip(pdf["block"], pdf["phi"]):
            phi = np.frombuffer(raw, "<f8")
            if b == block:
                total = total + phi
            else:
                if block is not None:
                    yield pd.DataFrame({"of": [block], "phi": [total.tobytes()]})
                block, total = b, phi
    if block is not None:
        yield pd.DataFrame({"of": [block], "phi": [total.tobytes()]})


def _unpack_rows(names: list[str]):
    m = len(names)

    def run(batches):
        for pdf in batches:
            for keys, x, phi in zip(pdf["keys"], pdf["x"], pdf["phi"]):
                yield pd.DataFrame({
                    "key": np.repeat(np.asarray(keys, dtype=object), m), "feature": np.tile(np.array(names, dtype=object), len(keys)),
                    "value": np.frombuffer(x, "<f8"), "contribution": np.frombuffer(phi, "<f8"),
                })

    return run


def shap_values(df: DataFrame, tree_model, features: list[str], id_col: str = "ID", most_nodes: int = SHAP_NODES, most_rows: int = SHAP_ROWS) -> DataFrame:
    """Long table (id, feature, value, contribution); the id keeps its name and type.

    The model's nodes stay a table: trees are packed in chunks, rows in blocks, every (block, chunk) pair is one
    group, and a block's contributions are summed over the chunks. Nothing of the model is broadcast
    or collected, so a forest that grew with the data is spread over the tasks like the rows are.
    """
    ship_by_value()
    spark, names, kind = df.sparkSession, list(features), dict(df.dtypes)[id_col]
    nodes = node_table(spark, tree_model)
    chunk_of = tree_chunks(nodes, most_nodes)
    chunks = max(c for _, c in chunk_of) + 1
    chunked = nodes.join(F.broadcast(spark.createDataFrame(chunk_of, "tree int, chunk int")), "tree")  # one row a tree
    packed = chunked.groupBy("chunk").applyInPandas(_pack_trees(tree_weights(tree_model), isinstance(tree_model, RandomForestClassificationModel)), "chunk int, trees binary")
    thin = df.select(F.col(id_col).cast("string").alias("key"), *[F.col(c).cast("double").alias(c) for c in names])
    rows = thin.count()
    count = max(1, -(-rows // most_rows), min(4 * spark.sparkContext.defaultParallelism, -(-rows // 256)))
    blocks = materialize(thin.repartition(count).mapInPandas(_pack_rows(names), "block int, keys array<string>, x binary"), "shap-rows")
    left = blocks.select("block", "x", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("part"))
    right = packed.select("trees", "chunk", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("to"))
    parts = left.groupBy("block", "part").cogroup(right.groupBy("to", "chunk")).applyInPandas(_explain_block(len(names)), "block int, phi binary")
    summed = parts.repartition("block").sortWithinPartitions("block").mapInPandas(_sum_chunks, "of int, phi binary")
    whole = blocks.join(summed, F.col("block") == F.col("of")).select("keys", "x", "phi")
    out = whole.mapInPandas(_unpack_rows(names), "key string, feature string, value double, contribution double")
    return out.select(F.col("key").cast(kind).alias(id_col), "feature", "value", "contribution")


def shap_summary(contrib: DataFrame) -> DataFrame:
    """Feature ranking by mean |contribution| with value spread."""
    return contrib.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (F.covar_pop("value", "contribution")
         / F.nullif(F.stddev_pop("value") * F.stddev_pop("contribution"), F.lit(0.0))).alias("value_contribution_corr"),
    )


# ---------------------------------------------------------------------------
# additive family
# ---------------------------------------------------------------------------

def _flat_stages(model) -> list:
    out = []
    for st in getattr(model, "stages", [model]):
        out.extend(_flat_stages(st) if isinstance(st, PipelineModel) else [st])
    return out


def additive_model(base: PipelineModel) -> AdditiveModel:
    return next(s for s in _flat_stages(base) if isinstance(s, AdditiveModel))


def additive_terms(base: PipelineModel, df: DataFrame, id_col: str = "ID") -> tuple[DataFrame, DataFrame]:
    """(shape table, importance (feature, mean_abs_contribution) over the rows of ``df``)."""
    model = additive_model(base)
    names = F.lit(model.term_names())
    long = model.contributions(df).select(id_col, F.explode(F.arrays_zip(names.alias("feature"), F.col("_terms").alias("contribution"))).alias("e"))
    importance = long.groupBy("e.feature").agg(F.avg(F.abs("e.contribution")).alias("mean_abs_contribution"))
    return model.shape_table(df.sparkSession), importance


# ---------------------------------------------------------------------------
# routing (X1, X2)
# ---------------------------------------------------------------------------

def explain_global(model, df: DataFrame, id_col: str = "ID") -> DataFrame | None:
    """Route by family: trees → SHAP summary, additive → term importance."""
    base = model.base_model()
    stages = _flat_stages(base)
    if model.family in TREE_FAMILIES:
        tree_stage = next(s for s in stages if isinstance(s, (BoostedTreesModel, ForestModel, RandomForestClassificationModel)))
        own = isinstance(tree_stage, (BoostedTreesModel, ForestModel))
        names = tree_stage.fitted()["features"] if own else next(s for s in stages if isinstance(s, VectorAssembler)).getInputCols()
        return shap_summary(shap_values(df, tree_stage, names, id_col))
    if model.family == "ebm":
        return additive_terms(base, df, id_col)[1]
    log.warning("no explanation is built for family %s", model.family)
    return None
