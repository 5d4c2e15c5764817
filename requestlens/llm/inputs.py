"""The given tables as the operators here read them, and small helpers they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(0))


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes, so that very long texts do not meet by the thousand in one batch."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", "8m"), ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")):
        spark.conf.set(key, value)
