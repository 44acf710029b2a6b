"""Split contract: exact hold-out, balanced folds, determinism, fold views."""

import pytest
from pyspark.sql import functions as F

from propensio.config import DataSpec
from propensio.operators import splits
from propensio.sources.tables import clients_view
from tests.conftest import SF_MID, SF_SMALL


def _fold_table(df, spec):
    return {(r["s"], r[spec.fold_col]): r["n"] for r in df.groupBy(
        F.concat_ws("_", *spec.target_cols).alias("s"), spec.fold_col).count().withColumnRenamed("count", "n").collect()}


@pytest.mark.parametrize("sf_dir,n,n_test", [(SF_SMALL, 150, 30), (SF_MID, 1500, 300)])
def test_exact_holdout_and_balanced_folds(spark, sf_dir, n, n_test):
    spec = DataSpec()
    folded = splits.assign_folds(clients_view(spark, sf_dir), spec).persist()
    counts = {r[spec.fold_col]: r["count"] for r in folded.groupBy(spec.fold_col).count().collect()}
    assert sum(counts.values()) == n
    assert counts[-1] == n_test
    assert -5 not in counts
    sizes = [counts[k] for k in range(spec.n_splits)]
    assert max(sizes) - min(sizes) <= 1
    table = _fold_table(folded, spec)
    for stratum in {s for s, _ in table}:
        per_fold = [table.get((stratum, k), 0) for k in range(spec.n_splits)]
        assert max(per_fold) - min(per_fold) <= 1
    assert spec.stratify_col not in folded.columns
    assert folded.columns[-1] == spec.fold_col


def test_same_seed_same_folds_under_repartitioning(spark):
    spec = DataSpec()
    base = clients_view(spark, SF_MID)
    a = splits.assign_folds(base.repartition(1), spec).select("ID", spec.fold_col)
    b = splits.assign_folds(base.repartition(13, "Age"), spec).select("ID", spec.fold_col)
    assert sorted(a.collect()) == sorted(b.collect())
    c = splits.assign_folds(base, DataSpec(seed=7)).select("ID", spec.fold_col)
    assert sorted(a.collect()) != sorted(c.collect())


def test_row_count_test_size_and_small_strata(spark):
    rows = [(i, i % 2, 1 if i < 3 else 0) for i in range(40)]  # stratum 0_1/1_1 has 3 rows < 5 folds
    df = spark.createDataFrame(rows, "ID long, AccumulationInvestment int, IncomeInvestment int")
    spec = DataSpec(test_size=7, n_splits=5)
    out = splits.assign_folds(df, spec)
    counts = {r[0]: r[1] for r in out.groupBy(spec.fold_col).count().collect()}
    assert counts[-1] == 7
    sizes = [counts.get(k, 0) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_fold_views(spark):
    spec = DataSpec()
    folded = splits.assign_folds(clients_view(spark, SF_SMALL), spec)
    tv, test = splits.splits(folded, spec)
    assert tv.count() == 120 and test.count() == 30
    ids_tv = {r[0] for r in tv.select("ID").collect()}
    ids_test = {r[0] for r in test.select("ID").collect()}
    assert not ids_tv & ids_test
    train, val = splits.cv_fold(folded, 2, spec)
    assert train.count() + val.count() == 120
    assert val.where(F.col(spec.fold_col) != 2).count() == 0
    with pytest.raises(ValueError):
        splits.cv_fold(folded, 5, spec)
    xy = splits.split_xy(tv, "IncomeInvestment", spec)
    assert "label" in xy.columns and spec.fold_col not in xy.columns
    assert not set(spec.target_cols) & set(xy.columns)
    assert {r[0] for r in xy.select("label").distinct().collect()} <= {0, 1}
    with pytest.raises(KeyError):
        splits.split_xy(tv, "Nope", spec)


def test_label_folds_are_stratified_and_deterministic(spark):
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(503)]
    df = spark.createDataFrame(rows, "ID long, label int")
    a = splits.assign_label_folds(df, "label", n_splits=5, seed=42)
    counts = {}
    for r in a.collect():
        counts[(r["label"], r["_cv_fold"])] = counts.get((r["label"], r["_cv_fold"]), 0) + 1
    for label in (0, 1):
        per_fold = [counts.get((label, k), 0) for k in range(5)]
        assert max(per_fold) - min(per_fold) <= 1
    b = splits.assign_label_folds(df.repartition(7), "label", n_splits=5, seed=42)
    assert sorted(a.select("ID", "_cv_fold").collect()) == sorted(b.select("ID", "_cv_fold").collect())
    assert set(a.columns) == {"ID", "label", "_cv_fold"}
