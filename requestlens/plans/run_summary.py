"""Outcome of one run: ingest, validation, models and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.plans import suite as Q


def summarize(
    stats: DataFrame, results: DataFrame, checks: DataFrame, models_built: bool = True, fail_on_critical: bool = False
) -> DataFrame:
    """One row. A failed ingest row or model build stops the run; expectations and tests are recorded only,
    unless ``fail_on_critical`` makes critical expectations block."""
    totals = stats.agg(
        F.sum("fetched").alias("records_fetched"),
        F.sum("upserted").alias("records_upserted"),
        F.sum("failed").alias("records_failed"),
        F.count("*").alias("batches"),
    )
    row = totals.withColumns({
        "ingestion_success": F.col("records_failed") == 0,
        "validation_success": Q.statistics(results).select("success").scalar(),
        "critical_passed": Q.gate(results).select("passed").scalar(),
        "models_success": F.lit(models_built),
        "tests_success": checks.agg(F.every("passed")).scalar(),
    })
    overall = F.col("ingestion_success") & F.col("models_success")
    if fail_on_critical:
        overall = overall & F.col("critical_passed")
    return row.withColumn("overall_success", overall)
