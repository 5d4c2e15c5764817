"""Marts, aggregates and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens.catalog import inputs as I
from requestlens.catalog import oracle as O
from requestlens.catalog.oracle import CALENDAR, DIMS, ENRICHED, FACT, STAGED, over, percent, rounded
from requestlens.catalog.registry import query
from requestlens.functions.numeric import percent as percent_of
from requestlens.operators.quantiles import grouped_quantile
from requestlens.operators.row_index import with_row_index
from requestlens.plans import checks as K
from requestlens.plans import dimensions as D
from requestlens.plans import marts as M
from requestlens.session import store

c = F.col
_COUNTS = "count(*) FILTER (WHERE sla_compliant) AS sla_compliant_count, count(*) FILTER (WHERE NOT sla_compliant) AS sla_breached_count"
_RATE = percent("count(*) FILTER (WHERE sla_compliant)", "count(sla_compliant)")
_DAILY_INPUT = ["closed_date", "status", "agency", "agency_name", "complaint_type", "descriptor", "borough"]


def daily_input(spark, folder):
    """The enriched columns the daily mart reads, as a table."""
    rows = I.enriched(spark, folder, *_DAILY_INPUT)
    return store(
        rows.select(
            "created_date_key", "agency_code", "agency_name", "borough", "complaint_category", "status", "resolution_days",
            "sla_compliant", "open_request_age_days",
        ),
        "enriched",
    )


DAILY_SQL = over(ENRICHED, f"""
SELECT created_date_key AS date_key, agency_code, agency_name, borough, complaint_category, count(*) AS request_count,
  count(*) FILTER (WHERE status = 'Closed') AS closed_count, count(*) FILTER (WHERE status = 'Open') AS open_count,
  round(avg(resolution_days), 6) AS avg_resolution_days, round(quantile_cont(resolution_days, 0.5), 6) AS median_resolution_days,
  {_COUNTS}, {_RATE} AS sla_compliance_rate, round(avg(open_request_age_days), 6) AS avg_open_request_age_days
FROM enr GROUP BY ALL""")


@query("daily_agency_metrics", DAILY_SQL)
def daily_agency_metrics(spark, folder):
    daily = M.daily_agency_metrics(daily_input(spark, folder))
    return daily.withColumns(I.six("avg_resolution_days", "median_resolution_days", "avg_open_request_age_days"))


@query("status_counts", over(ENRICHED, """
SELECT agency_code, count(*) AS request_count, count(*) FILTER (WHERE status = 'Closed') AS closed_count,
  count(*) FILTER (WHERE status = 'Open') AS open_count FROM enr GROUP BY 1"""))
def status_counts(spark, folder):
    rows = I.staged(spark, folder, "agency", "status")
    return rows.groupBy("agency_code").agg(
        F.count("*").alias("request_count"), F.count_if(c("status") == "Closed").alias("closed_count"),
        F.count_if(c("status") == "Open").alias("open_count"),
    )


@query("avg_resolution", over(ENRICHED, "SELECT borough, status, round(avg(resolution_days), 6) AS avg_resolution_days FROM enr GROUP BY ALL"))
def avg_resolution(spark, folder):
    rows = I.enriched(spark, folder, "closed_date", "borough", "status")
    return rows.groupBy("borough", "status").agg(F.round(F.avg("resolution_days"), 6).alias("avg_resolution_days"))


@query("median_resolution", over(ENRICHED, """
SELECT agency_code, borough, round(quantile_cont(resolution_days, 0.5), 6) AS median_resolution_days
FROM enr WHERE resolution_days IS NOT NULL GROUP BY ALL"""))
def median_resolution(spark, folder):
    rows = I.enriched(spark, folder, "closed_date", "agency", "borough").select("agency_code", "borough", "resolution_days")
    median = grouped_quantile(store(rows, "enriched"), ["agency_code", "borough"], "resolution_days", "median_resolution_days")
    return median.withColumns(I.six("median_resolution_days"))


@query("sla_counts", over(ENRICHED, f"SELECT complaint_category, {_COUNTS} FROM enr GROUP BY 1"))
def sla_counts(spark, folder):
    rows = I.enriched(spark, folder, "closed_date", "agency", "complaint_type")
    met, missed, _ = M.compliance_columns()
    return rows.groupBy("complaint_category").agg(met, missed)


@query("sla_rate", over(ENRICHED, f"SELECT agency_code, complaint_category, {_RATE} AS sla_compliance_rate FROM enr GROUP BY ALL"))
def sla_rate(spark, folder):
    rows = I.enriched(spark, folder, "closed_date", "agency", "complaint_type")
    return rows.groupBy("agency_code", "complaint_category").agg(M.compliance_columns()[2])


@query("top_category_mode", over(ENRICHED, """
SELECT agency_code, borough, complaint_category AS top_complaint_category FROM (
  SELECT agency_code, borough, complaint_category, row_number() OVER (PARTITION BY agency_code, borough ORDER BY count(*) DESC, complaint_category) AS rn
  FROM enr GROUP BY agency_code, borough, complaint_category) WHERE rn = 1"""))
def top_category_mode(spark, folder):
    rows = I.enriched(spark, folder, "agency", "borough", "complaint_type")
    return rows.groupBy("agency_code", "borough").agg(F.mode("complaint_category", True).alias("top_complaint_category"))


@query("emergency_rate", over(ENRICHED, f"""
SELECT agency_code, {percent("count(*) FILTER (WHERE is_emergency)", "count(*)")} AS emergency_request_rate_pct FROM enr GROUP BY 1"""))
def emergency_rate(spark, folder):
    rows = I.enriched(spark, folder, "agency", "complaint_type")
    return rows.groupBy("agency_code").agg(
        percent_of(F.count_if("is_emergency"), F.count("*")).alias("emergency_request_rate_pct")
    )


@query("monthly_borough_performance", over(FACT + CALENDAR, f"""
SELECT d.year, d.month, d.quarter, f.borough_key, b.borough_name, b.county_name, count(*) AS total_requests,
  count(*) FILTER (WHERE status = 'Closed') AS closed_requests, count(*) FILTER (WHERE status = 'Open') AS open_requests,
  {rounded("avg(resolution_days)")} AS avg_resolution_days, {rounded("quantile_cont(resolution_days, 0.5)")} AS median_resolution_days,
  {_COUNTS}, {_RATE} AS sla_compliance_rate_pct, {rounded("avg(open_request_age_days)")} AS avg_open_request_age_days
FROM fact f JOIN dim_date d ON d.date_key = f.created_date_key LEFT JOIN dim_borough b ON b.borough_key = f.borough_key
GROUP BY ALL"""))
def monthly_borough_performance(spark, folder):
    fact = I.stored_fact(
        spark, folder, "created_date_key", "borough", "borough_key", "status", "resolution_days", "sla_compliant",
        "open_request_age_days",
    )
    boroughs = I.stored_dims(fact, "borough")["borough"]
    return M.monthly_borough_performance(fact, D.dim_date(spark), boroughs)


_CARD_INPUT = [
    "created_at", "agency_code", "agency_key", "agency_name", "status", "resolution_days", "sla_compliant",
    "complaint_category", "is_emergency",
]


def scorecard(spark, folder):
    fact = I.monthly_fact(spark, folder, *_CARD_INPUT)
    return M.agency_sla_scorecard(fact, I.stored_dims(fact, "agency")["agency"])


_CARD_SQL = f"""
SELECT f.agency_key, f.agency_name, a.agency_domain, count(*) AS total_requests_90d,
  count(*) FILTER (WHERE status = 'Closed') AS closed_requests_90d, count(*) FILTER (WHERE status = 'Open') AS open_requests_90d,
  {rounded("avg(resolution_days)")} AS avg_resolution_days, {rounded("quantile_cont(resolution_days, 0.5)")} AS median_resolution_days,
  {_COUNTS}, {_RATE} AS sla_compliance_rate_pct, min(top.complaint_category) AS top_complaint_category,
  {percent("count(*) FILTER (WHERE is_emergency)", "count(*)")} AS emergency_request_rate_pct
FROM recent f JOIN dim_agency a ON a.agency_key = f.agency_key
JOIN (SELECT agency_key, agency_name, complaint_category, row_number() OVER (
    PARTITION BY agency_key, agency_name ORDER BY count(*) DESC, complaint_category) AS rn
  FROM recent GROUP BY agency_key, agency_name, complaint_category) top
  ON top.agency_key = f.agency_key AND top.agency_name IS NOT DISTINCT FROM f.agency_name AND top.rn = 1
GROUP BY f.agency_key, f.agency_name, a.agency_domain"""
_RECENT = """,
recent AS (SELECT * FROM fact WHERE created_at >= (SELECT max(created_at) - INTERVAL 90 DAY FROM fact))"""


@query("agency_sla_scorecard", over(FACT + _RECENT, _CARD_SQL))
def agency_sla_scorecard(spark, folder):
    return scorecard(spark, folder)


@query("scorecard_ranked", over(FACT + _RECENT, f"""
SELECT agency_key, agency_name, sla_compliance_rate_pct,
  CAST(row_number() OVER (ORDER BY sla_compliance_rate_pct ASC NULLS LAST, agency_key, agency_name) AS INTEGER) AS position
FROM ({_CARD_SQL})"""))
def scorecard_ranked(spark, folder):
    # Names are free text, so positions come from ranges of rows instead of one window.
    order = [F.asc_nulls_last("sla_compliance_rate_pct"), F.asc("agency_key"), F.asc("agency_name")]
    ranked = with_row_index(scorecard(spark, folder).select("agency_key", "agency_name", "sla_compliance_rate_pct"), order, "position")
    return ranked.withColumn("position", (F.col("position") + 1).cast("int"))


@query("dim_agency", over(STAGED + DIMS, "SELECT * FROM dim_agency"))
def dim_agency(spark, folder):
    return D.dim_agency(I.staged(spark, folder, "agency", "agency_name"))


@query("dim_borough", over(STAGED + DIMS, "SELECT * FROM dim_borough"))
def dim_borough(spark, folder):
    return D.dim_borough(I.staged(spark, folder, "borough"))


@query("dim_complaint_type", over(STAGED + DIMS, "SELECT * FROM dim_complaint"))
def dim_complaint_type(spark, folder):
    return D.dim_complaint_type(I.staged(spark, folder, "complaint_type", "descriptor"))


@query("dup_keys", over(O.RAW, "SELECT unique_key, count(*) AS cnt FROM raw WHERE unique_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1"))
def dup_keys(spark, folder):
    return K.duplicate_keys(I.raw(spark, folder, "unique_key"), "unique_key")
