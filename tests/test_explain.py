"""TreeSHAP: additivity and equality with brute-force Shapley values."""

import itertools
import math

import numpy as np

from propensio.operators.explain import expected_value, model_output, tree_shap_batch


def tiny_tree():
    # node 0: x0 <= 0.5 ? node 1 : node 2 ; node 1: x1 <= 0.3 ? 3 : 4 ; node 2: x1 <= 0.7 ? 5 : 6
    left = np.array([1, 3, 5, -1, -1, -1, -1])
    right = np.array([2, 4, 6, -1, -1, -1, -1])
    feat = np.array([0, 1, 1, -1, -1, -1, -1])
    thr = np.array([0.5, 0.3, 0.7, 0, 0, 0, 0])
    value = np.array([0, 0, 0, 1.0, 3.0, -2.0, 5.0])
    cover = np.array([100.0, 60.0, 40.0, 20.0, 40.0, 30.0, 10.0])
    return {"left": left, "right": right, "feature": feat, "threshold": thr, "value": value, "cover": cover, "weight": 0.7}


def cond_expectation(tree, x, subset):
    """Path-dependent E[f | x_S]: follow known features, cover-weight the others."""
    def walk(j):
        if tree["left"][j] < 0:
            return tree["value"][j]
        f = tree["feature"][j]
        if f in subset:
            return walk(tree["left"][j] if x[f] <= tree["threshold"][j] else tree["right"][j])
        lc, rc = tree["left"][j], tree["right"][j]
        return (tree["cover"][lc] * walk(lc) + tree["cover"][rc] * walk(rc)) / tree["cover"][j]
    return tree["weight"] * walk(0)


def brute_shap(tree, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [k for k in range(m) if k != i]
        for size in range(len(others) + 1):
            for s in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                phi[i] += w * (cond_expectation(tree, x, set(s) | {i}) - cond_expectation(tree, x, set(s)))
    return phi


def test_tree_shap_matches_brute_force_and_adds_up():
    tree = tiny_tree()
    X = np.array([[0.2, 0.1, 9.0], [0.9, 0.9, 1.0], [0.5, 0.3, 0.0], [0.7, 0.2, 3.0]])
    phi = np.zeros((len(X), 3))
    tree_shap_batch(X, tree, phi)
    ev = expected_value([tree])
    for r in range(len(X)):
        assert np.allclose(phi[r], brute_shap(tree, X[r], 3), atol=1e-12)
        assert math.isclose(phi[r].sum() + ev, model_output(X[r], [tree]), abs_tol=1e-12)
    assert np.all(phi[:, 2] == 0)


def test_repeated_feature_on_a_path():
    # the same feature splits twice on one path
    tree = {"left": np.array([1, 3, -1, -1, -1]), "right": np.array([2, 4, -1, -1, -1]),
            "feature": np.array([0, 0, -1, -1, -1]), "threshold": np.array([0.5, 0.2, 0, 0, 0]),
            "value": np.array([0, 0, 4.0, 1.0, 2.0]), "cover": np.array([10.0, 6.0, 4.0, 2.0, 4.0]), "weight": 1.0}
    X = np.array([[0.1, 0.0], [0.3, 5.0], [0.8, 1.0]])
    phi = np.zeros((3, 2))
    tree_shap_batch(X, tree, phi)
    for r in range(3):
        assert np.allclose(phi[r], brute_shap(tree, X[r], 2), atol=1e-12)


def test_additive_terms_add_up_to_the_margin(spark):
    import random

    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from propensio.operators.additive import AdditiveClassifier
    from propensio.operators.explain import additive_terms

    rnd = random.Random(3)
    rows = []
    for i in range(300):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        rows.append((i, a, b, c, 1.0 if a + b * c + rnd.gauss(0, 0.2) > 0.8 else 0.0))
    df = spark.createDataFrame(rows, "ID long, a double, b double, c double, label double")
    model = AdditiveClassifier(inputCols=["a", "b", "c"], numBuckets=8, interactionBuckets=4, interactions=2).fit(df)
    shape, importance = additive_terms(PipelineModel(stages=[model]), df)
    assert importance.count() == 5  # 3 main effects + 2 pairs
    table = {(r["feature"], r["bin"]): r for r in shape.collect()}
    intercept = table[("(intercept)", 0)]["score"]
    # each row's contributions are scores of the table, add up to the margin, and average to 0 over the training rows
    p = model.transform(df).select("ID", vector_to_array("probability")[1].alias("p"))
    scored = model.contributions(df).join(p, "ID").collect()
    sums = [0.0] * 5
    for r in scored:
        margin = intercept + sum(r["_terms"])
        assert abs(1 / (1 + math.exp(-margin)) - r["p"]) < 1e-12
        sums = [s + t for s, t in zip(sums, r["_terms"])]
    assert max(map(abs, sums)) < 1e-9
    for name, scores in ((n, [r["_terms"][i] for r in scored]) for i, n in enumerate(model.term_names())):
        known = {round(r["score"], 12) for (f, _), r in table.items() if f == name}
        assert {round(s, 12) for s in scores} <= known
    mains = [r for (f, _), r in table.items() if f == "a"]
    assert sum(r["rows"] for r in mains) == 300 and min(r["low"] for r in mains) == -math.inf and max(r["high"] for r in mains) == math.inf


def test_bags_and_small_bins_change_the_additive_fit(spark):
    import random

    from propensio.operators.additive import AdditiveClassifier, merged_edges

    assert merged_edges([1.0, 2.0, 3.0], {0: 5, 1: 1, 2: 1, 3: 4}, 2) == [1.0, 3.0]
    assert merged_edges([1.0, 2.0], {0: 5, 1: 5, 2: 1}, 2) == [1.0]
    assert merged_edges([], {0: 9}, 2) == [] and merged_edges([1.0], {0: 1, 1: 1}, 5) == []
    rnd = random.Random(4)
    rows = [(i, x := rnd.random(), None if i % 20 == 0 else rnd.random(), 1.0 if x + rnd.gauss(0, 0.3) > 0.5 else 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "ID long, a double, b double, label double")

    def tables(**kw):
        return AdditiveClassifier(inputCols=["a", "b"], numBuckets=64, interactions=1, interactionBuckets=4, **kw).fit(df).fitted()

    one, eight, again, wide = tables(outerBags=1), tables(outerBags=8), tables(outerBags=8), tables(outerBags=1, minSamplesLeaf=50)
    assert eight == again and eight["bags"] == 8 and eight["terms"][0]["scores"] != one["terms"][0]["scores"]
    held = [k for k in wide["terms"][0]["rows"][:-1]]
    assert len(wide["edges"]["a"]) < len(one["edges"]["a"]) and min(held) >= 50
    assert one["terms"][1]["rows"][-1] == 20  # the missing values have a bin of their own


def test_shap_values_of_a_deep_forest_add_up_over_chunks(spark):
    import random

    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from propensio.operators.explain import expected_value, node_table, shap_values, tree_chunks, tree_tables

    rnd = random.Random(5)
    rows = [(f"row {i}", rnd.random(), rnd.random(), rnd.random(), float(rnd.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, a double, b double, c double, label double")
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    forest = RandomForestClassifier(numTrees=6, maxDepth=30, seed=1).fit(vec)
    assert max(t.depth for t in forest.trees) > 10
    chunks = tree_chunks(node_table(spark, forest), 150)
    assert len({c for _, c in chunks}) >= 3
    want = {r["name"]: r["p"] for r in forest.transform(vec).select("name", vector_to_array("probability")[1].alias("p")).collect()}
    base = expected_value(tree_tables(spark, forest))
    one = shap_values(df, forest, ["a", "b", "c"], "name")
    assert one.columns == ["name", "feature", "value", "contribution"] and one.dtypes[0][1] == "string"
    many = shap_values(df, forest, ["a", "b", "c"], "name", most_nodes=150, most_rows=40)
    for got in (one, many):
        sums = {r["name"]: r["s"] for r in got.groupBy("name").agg(F.sum("contribution").alias("s")).collect()}
        assert len(sums) == 300 and all(abs(sums[k] + base - p) < 1e-9 for k, p in want.items())
    a, b = ({(r["name"], r["feature"]): r["contribution"] for r in x.collect()} for x in (one, many))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_quantile_edges_are_planned_as_text(spark, monkeypatch):
    from pyspark.sql.functions import builtin

    from propensio.operators.additive import quantile_edges

    df = spark.createDataFrame([(float(i), float("nan") if i % 2 else None) for i in range(100)], "`a b` double, c double")
    plain, made = builtin.lit, []
    monkeypatch.setattr(builtin, "lit", lambda x: made.append(x) or plain(x))
    edges = quantile_edges(df.withColumnRenamed("a b", "a"), ["a", "c"], 4)
    assert edges == {"a": [24.0, 49.0, 74.0], "c": []}
    assert len(made) < 10
