"""Every text operator and the pipeline on nulls, very long texts and words, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from propensio.llm import queries
from propensio.session import materialize

LONG = "a rather long text of plain words with nothing in it at all 12345. " * 32_000  # 2.1 MB
WORD = "ab1-" * 50_000  # one word of 200,000 characters
ROWS = [
    (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \n\t", "en", None, 3), (4, LONG, "en", "a", len(LONG)), (5, WORD, "fr", "b", len(WORD)), (6, "short text here", "en", "b", 15),
    (6, "short text here", "en", "b", 15), (None, "no id at all", "fr", "b", 12), (8, "l'été est là, un peu tard", "fr", "a", 25), (9, "x", None, None, 1), (10, "yes", "en", "a", 3),
]
CLASH = ("_id", "_size", "_copy", "_bad", "_key", "_shared", "_first", "_gone", "id", "key", "row", "s", "h", "size", "score", "label", "chunk", "pos", "shard", "slot", "p_id", "bin")


def tables(spark, path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASH:
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 0), (4, None, None)]
    spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "a benchmark question of rather more than twelve words that nobody has ever asked here before today"), (2, None), (3, ""), (4, "no id")]
    spark.createDataFrame(items if rows else [], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("odd") / "sf", ROWS)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("none") / "sf", [])


PER_ROW = ("op1_minhash_near_dedup", "op2_toxicity", "op4_sharding", "op6_language_id", "op7_quality_lm", "op8_mixing", "op12_tokenizer_alignment")


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, odd, empty, name):
    out = queries.QUERIES[name](spark, odd)
    rows = out.collect()
    ids = sorted((r["doc_id"] for r in rows), key=str)
    wanted = sorted((r[0] for r in ROWS), key=str)
    assert ids == wanted
    none = queries.QUERIES[name](spark, empty)
    assert none.columns == out.columns and none.count() == 0


@pytest.mark.parametrize("name", ("op9_decontamination", "op10_license_scan"))
def test_matches_of_odd_rows(spark, odd, empty, name):
    rows = queries.QUERIES[name](spark, odd).collect()
    assert {r["doc_id"] for r in rows} <= {None, 4, 5, 6, 8, 9, 10} and queries.QUERIES[name](spark, empty).count() == 0
    if name.startswith("op9"):
        assert [(r["doc_id"], r["item_id"]) for r in rows] == [(None, 4)]


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    import corpus_pipeline

    docs = spark.read.parquet(f"{odd}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd)
        assert docs.columns == names
        docs = materialize(docs, "stage")
    assert docs.count() >= 4
    assert corpus_pipeline.run(spark, odd).count() == corpus_pipeline.run(spark, odd).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0
