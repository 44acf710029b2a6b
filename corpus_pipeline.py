"""Training-corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``, further ones
included, whatever their names. An empty table stays empty through every stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from propensio.llm.decontaminate import decontaminated  # noqa: E402
from propensio.llm.mixing import mixed_documents  # noqa: E402
from propensio.llm.near_dup import keep_one_per_group  # noqa: E402
from propensio.llm.queries import toxicity_training_rows  # noqa: E402
from propensio.llm.sharding import shard  # noqa: E402
from propensio.llm.toxicity import fit_toxicity  # noqa: E402
from propensio.session import materialize  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5; the model is trained on the labelled documents outside the held-out fifth.

    Null and empty texts score as texts without toxic words and stay; repeated rows are judged alike.
    """
    model = fit_toxicity(toxicity_training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return model.filter_clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 and more.

    Null and empty texts and rows with a null id stay. Repeated rows (id and text) are one document; rows that share an
    id but not the text are documents of their own.
    """
    return keep_one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts and ids stay; rows that share an id are checked each by itself; an empty benchmark removes nothing.
    """
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them.

    Texts without words are no part of a mix by words and go; null sources are one source; repeated rows are documents of their own.
    """
    return mixed_documents(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row: null sources are a stratum, null texts count as one byte, repeated rows get slots of their own."""
    return shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

ORACLE_SQL = None  # classifier, hashing sketches and seeds are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
