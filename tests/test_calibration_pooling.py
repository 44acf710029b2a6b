"""Isotonic fit of unrounded scores: pooled first, same function as the plain fit."""

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from propensio.operators.calibration import fit_isotonic, isotonic_points, pooled_points


def test_pooled_fit_equals_the_plain_fit(spark, monkeypatch):
    score = F.rand(3)
    df = spark.range(20000).select(score.alias("raw_score"), (F.rand(4) < score).cast("int").alias("label"))
    df = df.unionByName(df.limit(500)).persist()
    points = isotonic_points(df)
    plain = IsotonicRegression(featuresCol="raw_score", labelCol="target", weightCol="weight", predictionCol="plain").fit(points)
    given = []
    fit = IsotonicRegression.fit
    monkeypatch.setattr(IsotonicRegression, "fit", lambda self, data: given.append(data.count()) or fit(self, data))
    both = fit_isotonic(df).transform(plain.transform(points)).select("plain", "score").collect()
    assert given[0] < 2000 < points.count()  # blocks, not scores
    assert len(both) == points.count() and max(abs(r["plain"] - r["score"]) for r in both) < 1e-9
    assert pooled_points(points).agg(F.sum("weight")).collect()[0][0] == pytest.approx(20500)
    with pytest.raises(RuntimeError, match="blocks are left"):
        pooled_points(points, max_blocks=3)


def test_unrounded_query_keeps_every_score(spark):
    from propensio.plans import catalog
    from tests.conftest import SF_SMALL

    rows = catalog.QUERIES["isotonic_calibration_unrounded"](spark, SF_SMALL).orderBy("raw_score").collect()
    assert len(rows) > catalog.q_isotonic_calibration(spark, SF_SMALL).count()
    assert all(a["score"] <= b["score"] + 1e-12 for a, b in zip(rows, rows[1:]))
