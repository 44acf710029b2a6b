"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensio.llm.alignment import aligned_documents
from propensio.llm.decontaminate import contaminated_pairs
from propensio.llm.embedding_dedup import embedding_duplicates
from propensio.llm.langid import identify, learn_dictionaries
from propensio.llm.licenses import scan_licenses
from propensio.llm.mixing import mix
from propensio.llm.near_dup import near_duplicates
from propensio.llm.oracle_sql import ORACLE  # noqa: F401
from propensio.llm.quality_lm import judge
from propensio.llm.sharding import shard
from propensio.llm.topk import exact_top_k
from propensio.llm.toxicity import fit_toxicity, labelled_sample
from propensio.llm.url_filter import judge_urls
from propensio.llm.whitening import whiten

HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def toxicity_training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of a bounded sample of the labelled documents outside the held-out fifth."""
    return labelled_sample(docs, labels.where(f"not ({HELD_OUT})"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(toxicity_training_rows(docs, _table(spark, sf_dir, "labels")))
    scored = model.score(docs)
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.expr("case when quality = 0 or toxic = 1 then 1 when quality = 1 and toxic = 0 then 0 end").alias("bad"))
    return judge_urls(_table(spark, sf_dir, "pages"), outcomes)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, learn_dictionaries(docs.where(f"not ({HELD_OUT})")))
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")


def op7_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return judge(_table(spark, sf_dir, "documents"), trusted)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(_table(spark, sf_dir, "documents"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors.where("vec_id % 20 = 0"), vectors)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_toxicity, op3_url_filter, op4_sharding, op5_embedding_near_dedup,
        op6_language_id, op7_quality_lm, op8_mixing, op9_decontamination, op10_license_scan,
        op11_embedding_whitening, op12_tokenizer_alignment, op13_exact_top_k,
    )
}
