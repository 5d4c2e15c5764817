"""Rows that cannot be ingested, kept with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from requestlens.functions.temporal import parse_datetime
from requestlens.session import store
from requestlens.sources.landing import CORRUPT


def ingest_error(df: DataFrame) -> Column:
    """Reasons joined by ';', or null when the row is fit for the upsert."""
    reasons = [
        F.when(F.col("unique_key").isNull(), "missing unique_key"),
        F.when(parse_datetime(F.col("created_date")).isNull(), "unparseable created_date"),
    ]
    if CORRUPT in df.columns:
        reasons.insert(0, F.when(F.col(CORRUPT).isNotNull(), "corrupt record"))
    return F.nullif(F.concat_ws(";", *reasons), F.lit(""))


def with_error(df: DataFrame) -> DataFrame:
    return df.withColumn("_error", ingest_error(df))


def is_fit(df: DataFrame) -> Column:
    """True where ``ingest_error`` is null; false, never null, elsewhere."""
    fit = F.col("unique_key").isNotNull() & parse_datetime(F.col("created_date")).isNotNull()
    return fit & F.col(CORRUPT).isNull() if CORRUPT in df.columns else fit


def accepted(df: DataFrame) -> DataFrame:
    """Rows without an ingest error, tested directly: this filter is pushed towards the scan, texts are not built."""
    return df.where(is_fit(df))


def dead_letters(df: DataFrame) -> DataFrame:
    return with_error(df).where(F.col("_error").isNotNull()).withColumn("_batch_id", F.col("batch_id"))


def write_split(df: DataFrame, path: str) -> None:
    """Both outcomes in one pass over the input: folder ``rejected=false`` and folder ``rejected=true``."""
    marked = with_error(df).withColumn("rejected", F.col("_error").isNotNull())
    marked.write.mode("errorifexists").partitionBy("rejected").parquet(path)


def ingest_stats(df: DataFrame, seconds: float | None = None) -> DataFrame:
    """Per batch: fetched, upserted and failed rows, duration in seconds and rows per second.

    The duration is ``seconds``, as measured by the run of one batch, or else the span of the rows' ingest times.
    """
    rows = with_error(df)
    span = F.timestamp_diff("SECOND", F.min("ingested_at"), F.max("ingested_at"))
    per_batch = rows.groupBy("batch_id").agg(
        F.count("*").alias("fetched"),
        F.count_if(F.col("_error").isNull()).alias("upserted"),
        F.count_if(F.col("_error").isNotNull()).alias("failed"),
        (span if seconds is None else F.lit(round(seconds, 3))).alias("duration_seconds"),
    )
    rate = F.col("upserted") / F.greatest(F.col("duration_seconds"), F.lit(1 if seconds is None else 0.001))
    return per_batch.withColumn("records_per_second", F.round(rate, 2))


def observed_stats(df: DataFrame, batch_id: str, label: str = "landed") -> tuple[DataFrame, DataFrame]:
    """Store one batch with its errors, and its statistics as one row in the layout of ``ingest_stats``.

    The statistics are observed while the rows are written, so they cost no second scan. Returns (stored rows, statistics).
    """
    spark = df.sparkSession
    seen = Observation(label)
    span = F.timestamp_diff("SECOND", F.min("ingested_at"), F.max("ingested_at"))
    watched = with_error(df).observe(
        seen, F.count("*").alias("fetched"), F.count_if(F.col("_error").isNull()).alias("upserted"),
        F.count_if(F.col("_error").isNotNull()).alias("failed"), span.alias("duration_seconds"),
    )
    stored = store(watched, label)
    counts = seen.get
    row = spark.createDataFrame(
        [(batch_id, counts["fetched"], counts["upserted"], counts["failed"], counts["duration_seconds"])],
        "batch_id string, fetched long, upserted long, failed long, duration_seconds long",
    )
    rate = F.col("upserted") / F.greatest(F.col("duration_seconds"), F.lit(1))
    return stored, row.withColumn("records_per_second", F.round(rate, 2))
