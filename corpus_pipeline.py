"""From raw documents to packed token sequences, in stages.

Each stage takes (spark, docs, folder of tables) and returns the documents it
keeps, with the columns of ``documents``; the last returns the pieces of packed
sequences. ``run`` writes what a stage returns to the shared scratch folder and
reads it again for the next one.

Defined results: an empty table passes every stage and gives no pieces. Rows
without text, or whose text has no letter, go in the first stage. Rows without an
id are in no group of near duplicates and stay; rows that repeat as a whole are
one. Other columns of the documents are carried along until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import jaccard, language, mixing, packing, secrets
from quayside.llm.common import kept, ship


def clear_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters and ambiguous texts go."""
    return language.accepted(docs, language.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of every group of near duplicates the document with the least id."""
    groups = kept(jaccard.join(docs), "pipeline-groups")
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    found = docs.join(first, "doc_id", "left_semi").distinct()
    return found.select(docs.columns).union(docs.where("doc_id is null").select(docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secrets.redacted(docs, secrets.fit(docs), length="n_chars")


def weighted_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes it, shard by shard and shuffled inside."""
    mix = mixing.mixed(docs).repartition("shard").sortWithinPartitions("shard", "shard_order")
    return mix.select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(docs)


def _shipped(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, run where the executors have the package."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, folder)

    return run_stage


STAGES = [
    ("language_id", _shipped(clear_language)),
    ("near_duplicates", _shipped(one_of_each_group)),
    ("secret_scans", _shipped(without_secrets)),
    ("mixing", _shipped(weighted_mix)),
    ("packing", _shipped(packed_sequences)),
]

#: Trained models and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
