"""Stream scoring and the driver entry points."""

from pyspark.sql import functions as F

from propensio.functions.scores import probe_score
from propensio.plans import catalog
from propensio.streaming import score_stream, start_scoring
from tests.conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark, tmp_path):
    frame, model = catalog.fitted_features(spark, SF_SMALL)
    src = str(tmp_path / "in")
    frame.select("ID", *catalog.FSPEC.base_cols).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    q = start_scoring(score_stream(stream, model, score_fn=probe_score), "memory", "scored_clients", trigger_once=True)
    q.processAllAvailable()
    q.stop()
    got = sorted((r["ID"], r["score"]) for r in spark.sql("SELECT ID, score FROM scored_clients").collect())
    batch = model.transform(frame.select("ID", *catalog.FSPEC.base_cols)).withColumn("score", probe_score())
    want = sorted((r["ID"], r["score"]) for r in batch.collect())
    assert got == want


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 30
    assert df.columns[0] == "ID" and "label" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 20
    from importlib.util import find_spec

    from propensio.plans.catalog import QUERIES

    extra = set(qs) - set(QUERIES)  # the training-data queries come with their subpackage only
    there = find_spec("corpus_pipeline") and find_spec("propensio.llm") and find_spec("propensio.llm.queries")
    assert bool(extra) == bool(there) and set(QUERIES) <= set(qs)


def test_stream_scoring_with_calibrated_model(spark, tmp_path):
    from propensio.operators import splits
    from propensio.operators.models import PropensityModel

    frame, features = catalog.fitted_features(spark, SF_SMALL)
    xy = frame.select("ID", *catalog.FSPEC.base_cols, F.col("IncomeInvestment").cast("int").alias("label"))
    model = PropensityModel("random_forest", tree_scale=0.05, parallelism=5).fit(
        features.transform(splits.train_val_block(frame).select(
            "ID", *catalog.FSPEC.base_cols, F.col("IncomeInvestment").cast("int").alias("label"))))
    src = str(tmp_path / "in2")
    xy.write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = start_scoring(score_stream(stream, features, model=model), "memory", "scored_model", trigger_once=True)
    q.processAllAvailable()
    q.stop()
    got = sorted((r["ID"], r["score"], r["prediction"]) for r in spark.sql("SELECT * FROM scored_model").collect())
    batch = score_stream(spark.read.parquet(src), features, model=model)
    want = sorted((r["ID"], r["score"], r["prediction"]) for r in batch.collect())
    assert got == want and len(got) == 150
