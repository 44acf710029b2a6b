"""Rows and results are never lost without a word."""

import pytest
from pyspark.sql import Row


def test_null_labels_make_strata_of_their_own(spark):
    from propensio.functions.features import stratum_key

    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    keys = [r[0] for r in df.select(stratum_key(["a", "b"])).collect()]
    assert len(set(keys)) == 3 and keys[2] == "1_1"


def test_unscored_rows_fail_the_metrics(spark):
    from propensio.operators.metrics import binary_metrics

    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (None, 1)], "score double, label int")
    with pytest.raises(Exception, match="can't be measured"):
        binary_metrics(df, score_col="score", label_col="label").collect()


def test_null_groups_keep_their_prefix_sums(spark):
    from propensio.operators.metrics import prefix_sum_before

    df = spark.createDataFrame([(None, 0.1, 2), (None, 0.7, 3), ("x", 0.5, 5)], "g string, s double, n long")
    out = prefix_sum_before(df, ["g"], "s", "n", "before")
    assert sorted(r["before"] for r in out.collect()) == [0, 0, 2]


def test_unscored_trials_never_win(spark):
    from propensio.operators.tuning import best_trials, trials_frame

    rows = [{"trial": 0, "params": {}, "score": float("nan")}, {"trial": 1, "params": {}, "score": 0.9}, {"trial": 2, "params": {}, "score": None}]
    assert [r["trial"] for r in best_trials(trials_frame(spark, "t", rows)).collect()] == [1]


def test_large_local_report_raises(spark, tmp_path):
    from propensio.sources.files import write_json_rows

    with pytest.raises(ValueError, match="at most"):
        write_json_rows(spark.range(10_001), str(tmp_path / "r"), str(tmp_path / "r.json"))


def test_missing_and_broken_models_differ(spark, tmp_path):
    from propensio.operators.models import PropensityModel

    with pytest.raises(FileNotFoundError):
        PropensityModel.load(str(tmp_path / "none"))
    spark.createDataFrame([Row(v="not json")]).write.text(str(tmp_path / "bad/meta"))
    with pytest.raises(ValueError):
        PropensityModel.load(str(tmp_path / "bad"))


def test_cluster_without_shared_folder_is_refused():
    from propensio.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(type("S", (), {"sparkContext": Context}))
