"""One run from landed pages to curated tables: ingest, validation, models, checks, monitors, summary.

Tables live under one base folder: ``raw`` (month-partitioned requests, dead letters, suite results), ``reference`` (the policy
seed), ``intermediate``, ``curated`` and ``monitoring``; staging is a view.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.operators.cursor import batch_name, created_at, lookback_start, stamp
from requestlens.operators.dead_letters import ingest_stats, with_error
from requestlens.operators.merge import MergedTable
from requestlens.operators.upsert import INSTANT, MONTH, path_exists
from requestlens.plans import checks, dimensions, marts, monitors, suite
from requestlens.plans import fact as facts
from requestlens.plans.incremental import DAILY, ENRICHED, FACT, MONTHLY, MonthlyModels
from requestlens.plans.marts import newest_month
from requestlens.plans.run_summary import summarize
from requestlens.plans.staging import staged_requests
from requestlens.session import store
from requestlens.sources.landing import CORRUPT, conform, read_pages
from requestlens.sources.seeds import policy_frame

REQUESTS, REJECTED, RESULTS = "raw/requests", "raw/dead_letters", "raw/suite_results"


def _save(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def start_of_load(spark: SparkSession, base: str, as_of: str, full: bool, start: str | None) -> DataFrame:
    """One row: the creation instant from which records are taken."""
    if full:
        return spark.range(1).select(F.lit(start or V.FULL_LOAD_START).cast("timestamp_ntz").alias("since"))
    known = f"{base}/{REQUESTS}"
    if not path_exists(spark, known):
        return lookback_start(spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias(INSTANT)), as_of)
    return lookback_start(newest_month(spark.read.parquet(known), MONTH), as_of, created=INSTANT)


def ingest(
    spark: SparkSession, pages: str, base: str, as_of: str, full: bool = False, start: str | None = None, array_pages: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Upsert the landed records of the load window and keep the rejected ones.

    Returns the batch statistics, with the seconds that this took, and the accepted records.
    """
    began = time.monotonic()
    since = start_of_load(spark, base, as_of, full, start).scalar()
    moment = F.lit(as_of).cast("timestamp_ntz")
    read = stamp(read_pages(spark, pages, array_pages), batch_name(full, moment), as_of)
    # Records without a readable date stay in, to be rejected with their reason.
    window = with_error(read).where(F.coalesce(created_at() >= since, F.lit(True)))
    landed = store(window, "landed")
    rejected = landed.where(F.col("_error").isNotNull())
    rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{base}/{REJECTED}")
    fit = conform(landed.where(F.col("_error").isNull()).drop("_error", CORRUPT))
    MergedTable(spark, f"{base}/{REQUESTS}").merge(fit, as_of)
    return ingest_stats(landed, time.monotonic() - began), fit


def build_models(spark: SparkSession, base: str, as_of: str, whole: bool = False) -> dict[str, DataFrame]:
    """All models over the stored requests.

    Models by month are refreshed where merges have changed requests since the last run, or everywhere when ``whole``;
    dimensions come from stored partials, and the scorecard from the newest months of the fact.
    """
    table, monthly = MergedTable(spark, f"{base}/{REQUESTS}"), MonthlyModels(spark, base)
    requests = table.rows().drop(MONTH, INSTANT)
    staged = staged_requests(requests)
    staged.createOrReplaceTempView("stg_requests")
    policies = _save(policy_frame(spark), f"{base}/reference/sla_policies")
    dates = _save(dimensions.dim_date(spark, as_of=as_of), f"{base}/curated/dim_date")
    monthly.follow(table, policies, dates, as_of, whole)
    models = {
        "raw_requests": requests,
        "stg_requests": staged,
        "int_requests_enriched": monthly.read(ENRICHED).withColumnRenamed(MONTH, "created_month_key"),
        "int_daily_agency_metrics": monthly.read(DAILY).drop(MONTH),
        "dim_date": dates,
    }
    for name in ("agency", "borough", "complaint_type"):
        models[f"dim_{name}"] = _save(getattr(monthly, f"dim_{name}")(as_of), f"{base}/curated/dim_{name}")
    fact = monthly.read(FACT).withColumnRenamed(MONTH, facts.MONTH)
    models["fact_service_requests"] = fact
    models["agg_monthly_borough_performance"] = monthly.read(MONTHLY).drop(MONTH)
    card = marts.agency_sla_scorecard(fact, models["dim_agency"])
    models["agg_agency_sla_scorecard"] = _save(card, f"{base}/curated/agg_agency_sla_scorecard")
    return models


def run(
    spark: SparkSession, pages: str, base: str, as_of: str, full: bool = False, start: str | None = None,
    skip_validation: bool = False, skip_models: bool = False, fail_on_critical: bool = False, array_pages: bool = True,
) -> DataFrame:
    """Run all stages and return the one-row summary. A rejected record ends the run after the ingest.

    The suite reads the batch's own accepted records. Column tests, fact checks and monitors are stored under ``monitoring``; a
    column test of severity warn does not fail the run, and monitors only report.
    """
    stats, batch = ingest(spark, pages, base, as_of, full, start, array_pages)
    stats = store(stats, "ingest-stats")
    clean = stats.where(F.col("failed") > 0).isEmpty()
    results = spark.createDataFrame([], "severity string, success boolean")
    tested = spark.createDataFrame([], "passed boolean")
    if clean and not skip_validation:
        run_id = as_of.replace(" ", "T").replace(":", "")
        results = store(suite.checkpoint_run(batch, suite.request_suite(), run_id, whole=True), "suite-results")
        suite.save_results(results, f"{base}/{RESULTS}")
        blocked = fail_on_critical and not suite.gate(results).first()["passed"]
        clean = clean and not blocked
    built = clean and not skip_models
    if built:
        models = build_models(spark, base, as_of, whole=full)
        columns = _save(checks.run_column_tests(models, checks.request_model_tests()), f"{base}/monitoring/column_tests")
        facts_tested = _save(checks.fact_checks(models["fact_service_requests"]), f"{base}/monitoring/fact_checks")
        tested = facts_tested.select("passed").union(columns.select((F.col("status") != "fail").alias("passed")))
        watch(models["raw_requests"], base, as_of)
        table = MergedTable(spark, f"{base}/{REQUESTS}")
        changed = monitors.merged_status_changes(table.changes().where(F.col("merge") == table.last()))
        _save(changed, f"{base}/monitoring/status_changes")
    return summarize(stats, results, tested, models_built=built or (clean and skip_models), fail_on_critical=fail_on_critical)


def watch(requests: DataFrame, base: str, as_of: str) -> None:
    """Store the monitors over the raw requests: volume, nulls, freshness and completeness."""
    day = F.to_date(created_at())
    daily = store(monitors.daily_counts(requests, day), "daily-counts")
    timed = requests.withColumn("created_at", created_at())
    found = {
        "row_count_anomalies": monitors.row_count_anomalies(daily),
        "row_count_drops": monitors.row_count_drops(daily),
        "null_rates": monitors.null_rate_increases(monitors.null_rates(requests, day, requests.columns)),
        "freshness": monitors.freshness(timed, "created_at", as_of),
        "source_freshness": monitors.source_freshness(requests, as_of),
        "completeness": monitors.completeness(requests),
    }
    for name, result in found.items():
        _save(result, f"{base}/monitoring/{name}")
