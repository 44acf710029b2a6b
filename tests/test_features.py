"""Feature transform: fit on train only, edge values, column contract."""

import math

import pytest
from pyspark.sql import functions as F

from propensio.config import BASE_COLS, ENGINEERED_COLS
from propensio.operators.features import FeatureEngineer, FeatureModel
from propensio.operators.stats import exact_quantiles, spark_exact_quantiles

SCHEMA = "ID long, Age int, Gender int, FamilyMembers int, FinancialEducation int, RiskPropensity int, Income double, Wealth double"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(n, seed=42):
    import random

    rnd = random.Random(seed)
    return [(i, rnd.randint(18, 79), rnd.randint(0, 1), rnd.randint(1, 5), rnd.randint(1, 4), rnd.randint(1, 4),
             float(rnd.randint(20000, 199999)), float(rnd.randint(0, 999999))) for i in range(n)]


def test_fit_sets_stats_and_transform_contract(spark):
    train = _frame(spark, _rows(100))
    model = FeatureEngineer().fit(train)
    st = model.get_params()
    pdf = train.toPandas()
    assert st["p99_inc"] <= pdf.Income.max() and st["p99_wth"] <= pdf.Wealth.max()
    assert st["inc_max"] == pdf.Income.max()
    assert math.isclose(st["medians"]["Age"], pdf.Age.median())
    out = model.transform(train)
    assert out.columns == ["ID"] + list(BASE_COLS) + list(ENGINEERED_COLS)
    assert model.n_features_out == 16
    assert out.count() == 100
    nulls = out.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).collect()[0]
    assert all(v == 0 for v in nulls)
    brackets = out.select((F.col("Age_bracket_Young") + F.col("Age_bracket_Mid") + F.col("Age_bracket_Senior")).alias("s"))
    assert {r[0] for r in brackets.distinct().collect()} == {1}
    # fit_transform == fit then transform
    again = FeatureEngineer().fit(train).transform(train)
    assert sorted(again.collect()) == sorted(out.collect())


def test_train_statistics_are_locked(spark):
    train = _frame(spark, _rows(80, 10))
    test = _frame(spark, [(1000 + r[0],) + r[1:] for r in _rows(20, 99)])
    model = FeatureEngineer().fit(train)
    before = model.get_params()
    model.transform(test).collect()
    assert model.get_params() == before
    refit = FeatureEngineer().fit(test).get_params()
    assert refit != before


def test_edge_values(spark):
    rows = [
        (1, 17, 0, 0, 1, 1, None, 0.0),
        (2, 18, 1, None, 1, 1, float("nan"), -1.0),
        (3, 35, 0, 1, 1, 1, 0.0, -5.0),
        (4, 36, 1, 2, 1, 1, -1.0, 100.0),
        (5, 55, 0, 3, 1, 1, 50000.0, 2e6),
        (6, 56, 1, 3, 1, 1, 60000.0, 3e6),
        (7, 100, 0, 3, 1, 1, 70000.0, 4e6),
        (8, 101, 1, 3, 1, 1, 9e9, 5e6),
        (9, None, 0, 3, 1, 1, 80000.0, 6e6),
    ]
    from propensio.sources.files import normalize_nan

    df = normalize_nan(_frame(spark, rows))
    model = FeatureEngineer(quantileMethod="spark_exact").fit(df)
    out = {r["ID"]: r for r in model.transform(df).collect()}
    med_age = model.get_params()["medians"]["Age"]
    flags = lambda r: (r["Age_bracket_Young"], r["Age_bracket_Mid"], r["Age_bracket_Senior"])
    assert flags(out[1]) == (0, 0, 0)
    assert flags(out[2]) == (1, 0, 0) and flags(out[3]) == (1, 0, 0)
    assert flags(out[4]) == (0, 1, 0) and flags(out[5]) == (0, 1, 0)
    assert flags(out[6]) == (0, 0, 1) and flags(out[7]) == (0, 0, 1)
    assert flags(out[8]) == (0, 0, 0)
    assert out[9]["Age"] == med_age
    # NaN and NULL incomes are imputed with the median, never NaN
    assert out[1]["Income"] == out[2]["Income"] == model.get_params()["medians"]["Income"]
    # log1p guard: wealth -5 (≤ -1) → NULL, wealth -1 → NULL
    assert out[3]["Wealth_log"] is None and out[2]["Wealth_log"] is None
    # zero wealth → ratio falls back to max income
    assert math.isclose(out[1]["Income_Wealth_Ratio_log"], math.log1p(model.get_params()["inc_max"]))
    # family 0 → median family size
    med_fm = model.get_params()["medians"]["FamilyMembers"]
    assert math.isclose(out[1]["Wealth_per_person"], 0.0 / med_fm)
    # income above p99 is clipped inside ratios but not in the base column
    assert out[8]["Income"] == 9e9
    assert out[8]["Income_per_person"] <= model.get_params()["p99_inc"] / 3 + 1e-9


def test_zero_median_family_gives_null_not_error(spark):
    rows = [(i, 30, 0, 0, 1, 1, 1000.0 + i, 10.0 + i) for i in range(5)]
    model = FeatureEngineer().fit(_frame(spark, rows))
    out = model.transform(_frame(spark, rows)).collect()
    assert all(r["Wealth_per_person"] is None for r in out)


def test_unfitted_and_missing_columns(spark):
    with pytest.raises(KeyError):
        FeatureEngineer().fit(spark.createDataFrame([(1, 2.0)], "ID long, Age double"))
    from propensio.operators.scaling import MinMaxColumns

    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "ID long, c double")
    scaled = MinMaxColumns(inputCols=["c"]).fit(df).transform(df)
    assert {r[0] for r in scaled.select("c").collect()} == {0.0}


def test_model_persistence(spark, tmp_path):
    train = _frame(spark, _rows(50))
    model = FeatureEngineer().fit(train)
    path = str(tmp_path / "fm")
    model.write().overwrite().save(path)
    loaded = FeatureModel.load(path)
    assert loaded.get_params() == model.get_params()
    assert sorted(loaded.transform(train).collect()) == sorted(model.transform(train).collect())


@pytest.mark.parametrize("n,seed", [(7, 1), (200, 2), (1001, 3)])
def test_exact_quantiles_equal_spark_percentile(spark, n, seed):
    import random

    rnd = random.Random(seed)
    rows = [(float(rnd.choice([0, 0, 1, 2.5, rnd.random() * 1e6])),) for _ in range(n)]
    df = spark.createDataFrame(rows, "x double")
    req = {"x": [0.0, 0.25, 0.5, 0.99, 1.0]}
    assert exact_quantiles(df, req, accuracy=50) == spark_exact_quantiles(df, req)


@pytest.mark.parametrize("few", [2, 10])
def test_quantile_search_narrows_until_few_values_are_left(spark, monkeypatch, few):
    import random

    from propensio.operators import stats

    monkeypatch.setattr(stats, "FEW", few)
    rnd = random.Random(few)
    columns = {
        "spread": lambda i: rnd.random() * 10.0 ** rnd.randint(-200, 200), "tied": lambda i: float(rnd.choice([1, 1, 1, 2, 3])), "half": lambda i: 4.0 if i % 2 else rnd.random() * 8,
        "holes": lambda i: None if i % 3 else float(i), "same": lambda i: 9.0, "empty": lambda i: None,
    }
    rows = [tuple(f(i) for f in columns.values()) for i in range(900)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    req = {c: [0.0, 0.01, 0.5, 0.77, 0.99, 1.0] for c in columns}
    got, want = exact_quantiles(df, req, accuracy=20), spark_exact_quantiles(df, req)
    assert got == want


def test_engineer_has_no_width_before_the_fit():
    assert FeatureEngineer().n_features_out == 0
