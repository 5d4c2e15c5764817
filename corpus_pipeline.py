"""A corpus from raw documents: toxic texts out, one of each group of near copies, no benchmark passages, sources mixed, sharded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from requestlens.llm import decontamination, jaccard, mixing, sharding, toxicity
from requestlens.llm.inputs import given
from requestlens.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of this folder, scores below 0.5."""
    return toxicity.keep_clean(docs, given(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 or more connect, that of the smallest id."""
    return jaccard.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage similar to a benchmark item of this folder."""
    return decontamination.keep_uncontaminated(docs, given(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy drawn, the last copy of a source's quota cut to the words that are left of it."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus: each row of the mix with its text, shard and slot, the shards as ``sharding.assign_shards`` has them."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
    ("sharding", assign_shards),
]

# A classifier and a pseudo-random draw decide; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as a table before the next one reads it."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
