"""The five actions end to end on the small tables."""

from pyspark.sql import functions as F

from propensio.plans import flows
from propensio.sources.tables import clients_view
from tests.conftest import SF_SMALL


def test_actions_end_to_end(spark, tmp_path):
    settings = flows.Settings(frozen_path=str(tmp_path / "frozen.parquet"), artifacts_dir=str(tmp_path / "art"),
                              family="xgboost", tree_scale=0.02, parallelism=5)
    prep = flows.data_prep(spark, clients_view(spark, SF_SMALL), settings, str(tmp_path / "processed"))
    train_fm = spark.read.parquet(prep["train"])
    assert train_fm.count() == 120 and spark.read.parquet(prep["test"]).count() == 30
    assert "IncomeInvestment" in train_fm.columns and len(train_fm.columns) == 18

    perf = flows.train(spark, settings).collect()
    assert {r["target"] for r in perf} == {"AccumulationInvestment", "IncomeInvestment"}

    metrics = flows.evaluate(spark, settings).collect()[0]
    assert 0.0 <= metrics["Brier_Score"] <= 1.0

    best = flows.tune(spark, settings, n_trials=2).collect()
    assert len(best) == 2

    settings.use_tuned_params = True
    settings.metrics_file = str(tmp_path / "metrics.json")
    assert set(flows.tuned_params(spark, settings)) == {"AccumulationInvestment", "IncomeInvestment"}
    perf2 = flows.train(spark, settings).collect()
    assert len(perf2) == 2
    flows.evaluate(spark, settings)
    import json

    assert "ROC_AUC" in json.load(open(settings.metrics_file))

    out = flows.audit(spark, settings, n_candidates=50)
    summary = out["explanation"].collect()
    assert len(summary) == 16
    cfs = out["counterfactuals"].collect()
    assert all(r["score"] >= 0.5 for r in cfs)
    assert all(r["cf_rank"] <= 3 for r in cfs)


def test_families_trained_after_different_freezes_evaluate_as_at_training(spark, tmp_path, caplog):
    clients = clients_view(spark, SF_SMALL)
    art = str(tmp_path / "art")
    first = flows.Settings(frozen_path=str(tmp_path / "a.parquet"), artifacts_dir=art, family="ebm", params={"outer_bags": 2, "interactions": 2, "max_bins": 16}, calibration="none")
    second = flows.Settings(frozen_path=str(tmp_path / "b.parquet"), artifacts_dir=art, family="random_forest", tree_scale=0.05, calibration="none")
    flows.freeze(spark, clients, first)
    flows.freeze(spark, clients.withColumn("Income", F.col("Income") * 3 + 1000).where("ID % 5 <> 1"), second)
    perf = {}
    for s in (first, second):
        perf[s.family] = {r["target"]: r.asDict() for r in flows.train(spark, s).collect()}
    for s in (first, second):
        for target, want in perf[s.family].items():
            got = flows.evaluate(spark, s, target).collect()[0].asDict()
            assert got == {k: v for k, v in want.items() if k != "target"}
    assert "another frozen table" not in caplog.text
    with caplog.at_level("WARNING"):
        flows.evaluate(spark, flows.Settings(frozen_path=second.frozen_path, artifacts_dir=art, family="ebm"))
    assert "another frozen table" in caplog.text
    out = flows.audit(spark, first, n_candidates=20)
    assert out["shapes"].where("feature = 'Income'").count() > 1 and spark.read.parquet(f"{art}/shapes_ebm").count() == out["shapes"].count()
