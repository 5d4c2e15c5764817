"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens.llm import (
    alignment, decontamination, expected, fingerprints, jaccard, languages, mixing, neighbours, quality, secrets, sharding, substrings, toxicity,
    vector_codes,
)
from requestlens.llm.inputs import given

Query = Callable[[SparkSession, str], DataFrame]


def op1_score_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(given(spark, folder, "documents"))


def op3_find_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_contamination(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


def op4_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(given(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_fingerprint_documents(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(given(spark, folder, "documents"))


def op6_find_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(given(spark, folder, "documents"))


def op7_identify_languages(spark: SparkSession, folder: str) -> DataFrame:
    found = languages.identify_languages(given(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op8_score_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op9_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(given(spark, folder, "documents"))


def op10_link_documents(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_documents(given(spark, folder, "documents"))


def op11_align_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(given(spark, folder, "documents"))


def op12_compress_vectors(spark: SparkSession, folder: str) -> DataFrame:
    codes, codebooks = vector_codes.encode_vectors(given(spark, folder, "embeddings"))
    digest = F.lit(vector_codes.digest(codebooks))
    return vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op13_find_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(given(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


QUERIES: dict[str, Query] = {
    "op1_score_toxicity": op1_score_toxicity,
    "op2_mix_sources": op2_mix_sources,
    "op3_find_contamination": op3_find_contamination,
    "op4_remove_repeats": op4_remove_repeats,
    "op5_fingerprint_documents": op5_fingerprint_documents,
    "op6_find_secrets": op6_find_secrets,
    "op7_identify_languages": op7_identify_languages,
    "op8_score_quality": op8_score_quality,
    "op9_shard_documents": op9_shard_documents,
    "op10_link_documents": op10_link_documents,
    "op11_align_tokens": op11_align_tokens,
    "op12_compress_vectors": op12_compress_vectors,
    "op13_find_neighbours": op13_find_neighbours,
}
ORACLES: dict[str, str] = {
    "op4_remove_repeats": expected.REPEATS,
    "op6_find_secrets": expected.SECRETS,
    "op10_link_documents": expected.LINKS,
    "op12_compress_vectors": expected.CODES,
    "op13_find_neighbours": expected.NEAREST,
}
