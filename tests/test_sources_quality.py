"""Sources, sinks and data-quality checks."""

import pytest
from pyspark.sql import functions as F

from propensio.config import DataSpec
from propensio.operators import quality
from propensio.sources.files import read_client_file, read_table
from propensio.sources.tables import clients_view
from tests.conftest import SF_MID


def test_clients_view_shape(spark):
    df = clients_view(spark, SF_MID)
    assert df.count() == 1500
    assert df.columns == ["ID", "Age", "Gender", "FamilyMembers", "FinancialEducation", "RiskPropensity", "Income",
                          "Wealth", "AccumulationInvestment", "IncomeInvestment"]
    row = df.agg(F.count_if(F.col("Income").isNull()).alias("n"), F.min("Age").alias("a"), F.max("Age").alias("b")).collect()[0]
    assert row["n"] == 30 and row["a"] >= 18 and row["b"] <= 79


def test_csv_source_trims_names_and_nan(spark, tmp_path):
    p = tmp_path / "clients.csv"
    p.write_text(" ID , Age ,Income\n1,30,NaN\n2,40,\n3,50,100.5\n")
    df = read_table(spark, str(p), schema=None)
    assert df.columns == ["ID", "Age", "Income"]
    vals = {r["ID"]: r["Income"] for r in df.collect()}
    assert vals[1] is None and vals[2] is None and vals[3] == 100.5
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "clients.xlsb"))
    with pytest.raises(FileNotFoundError):
        read_client_file(spark, str(tmp_path / "missing.parquet"))


def test_quality_checks(spark):
    dup = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, 0, 0)], "ID long, AccumulationInvestment int, IncomeInvestment int")
    with pytest.raises(ValueError):
        quality.check_unique_ids(dup)
    rep = quality.id_report(dup).collect()[0]
    assert rep["n_rows"] == 3 and rep["n_ids"] == 2 and rep["n_duplicated_ids"] == 1
    with pytest.raises(ValueError):
        quality.check_schema(dup.drop("IncomeInvestment"))
    with pytest.raises(ValueError):
        quality.check_min_rows(10, DataSpec(train_val_size=8, test_size=5))


def test_freeze_flow_reuses_stored_table(spark, tmp_path):
    from propensio.plans.flows import Settings, freeze

    settings = Settings(frozen_path=str(tmp_path / "frozen.parquet"), artifacts_dir=str(tmp_path / "art"))
    first = freeze(spark, clients_view(spark, SF_MID), settings)
    assert first.where(F.col("stratified_fold") == -1).count() == 300
    again = freeze(spark, "/nonexistent.parquet", settings)  # exists → not recomputed
    assert sorted(again.select("ID", "stratified_fold").collect()) == sorted(first.select("ID", "stratified_fold").collect())


def test_loader_cache_is_keyed_by_source(spark, tmp_path):
    from propensio.sources.files import ClientLoader

    frozen = tmp_path / "frozen.parquet"
    raw = tmp_path / "raw.parquet"
    clients_view(spark, SF_MID).limit(10).write.parquet(str(frozen))
    clients_view(spark, SF_MID).limit(5).write.parquet(str(raw))
    loader = ClientLoader(spark, str(frozen), str(raw))
    a = loader.load()
    assert loader.load() is a
    assert loader.load(use_frozen=False).count() == 5
    assert a.count() == 10
    loader.clear()
    with pytest.raises(FileNotFoundError):
        ClientLoader(spark, str(tmp_path / "nope.parquet")).load()


def test_freeze_rejects_impossible_test_size(spark, tmp_path):
    from propensio.plans.flows import Settings, freeze

    settings = Settings(frozen_path=str(tmp_path / "f.parquet"), artifacts_dir=str(tmp_path / "a"),
                        data=DataSpec(test_size=5000))
    with pytest.raises(ValueError):
        freeze(spark, clients_view(spark, SF_MID), settings)


def test_typed_csv_matches_the_header_and_reports_bad_rows(spark, tmp_path):
    from pyspark.sql import types as T

    from propensio.sources.files import bad_rows, read_clients, sound_rows

    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Age", T.IntegerType()), T.StructField("Income", T.DoubleType())])
    p = tmp_path / "clients.csv"
    p.write_text(" Income ,ID,note, Age\n1.5,1,x,30\nNaN,2,y,41\n,3,z,\nmuch,4,w,50\n2.5,5,v,old\n")
    marked = read_clients(spark, str(p), schema=schema, report_bad=True)
    good = sound_rows(marked)
    assert good.dtypes == [("Income", "double"), ("ID", "bigint"), ("note", "string"), ("Age", "int")]
    assert sorted((r.ID, r.Income, r.Age) for r in good.collect()) == [(1, 1.5, 30), (2, None, 41), (3, None, None)]
    assert sorted(r["_corrupt_record"] for r in bad_rows(marked).collect()) == ["2.5,5,v,old", "much,4,w,50"]
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        read_clients(spark, str(p), schema=schema).collect()
    with pytest.raises(ValueError, match="Wealth"):
        read_clients(spark, str(p), schema=T.StructType([*schema.fields, T.StructField("Wealth", T.DoubleType())]))
    with pytest.raises(FileNotFoundError):
        read_clients(spark, str(tmp_path / "none.csv"))
