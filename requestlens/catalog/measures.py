"""Dashboard measures, time intelligence and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog.oracle import CALENDAR, FACT, fraction, over, percent
from requestlens.catalog.registry import query
from requestlens.plans import calendar as C
from requestlens.plans import dimensions as D
from requestlens.plans import measures as M

c = F.col
_MET, _MISSED = "count(*) FILTER (WHERE sla_compliant)", "count(*) FILTER (WHERE NOT sla_compliant)"
_FRACTION = fraction(_MET, f"{_MET} + {_MISSED}")
_PCT = percent(_MET, "count(sla_compliant)")
_SLA_INPUT = ["closed_date", "agency", "complaint_type", "status"]


@query("m_base_counts", over(FACT, """
SELECT agency_key, borough_key, count(*) AS total_requests, count(*) FILTER (WHERE status = 'Closed') AS closed_requests,
  count(*) FILTER (WHERE status = 'Open') AS open_requests FROM fact GROUP BY ALL"""))
def m_base_counts(spark, folder):
    fact = I.fact(spark, folder, "agency", "borough", "status")
    return M.measure(fact, ["total_requests", "closed_requests", "open_requests"], ["agency_key", "borough_key"])


@query("m_resolution_positive", over(FACT, """
SELECT agency_key, round(avg(resolution_days) FILTER (WHERE resolution_days > 0), 5) AS avg_resolution_days,
  round(quantile_cont(resolution_days, 0.5) FILTER (WHERE resolution_days > 0), 5) AS median_resolution_days FROM fact GROUP BY 1"""))
def m_resolution_positive(spark, folder):
    fact = I.stored_fact(spark, folder, "agency_key", "resolution_days")
    return M.resolution_measures(fact, ["agency_key"]).withColumns({c: F.round(c, 5) for c in ("avg_resolution_days", "median_resolution_days")})


@query("m_resolution_overall", over(FACT, """
SELECT round(avg(resolution_days) FILTER (WHERE resolution_days > 0), 5) AS avg_resolution_days,
  round(quantile_cont(resolution_days, 0.5) FILTER (WHERE resolution_days > 0), 5) AS median_resolution_days FROM fact"""))
def m_resolution_overall(spark, folder):
    fact = I.stored_fact(spark, folder, "resolution_days")
    return M.resolution_measures(fact).withColumns({c: F.round(c, 5) for c in ("avg_resolution_days", "median_resolution_days")})


@query("m_sla_fraction", over(FACT, f"""
SELECT borough_key, {_MET} AS sla_compliant_count, {_MISSED} AS sla_breached_count, round({_FRACTION}, 9) AS sla_compliance FROM fact GROUP BY 1"""))
def m_sla_fraction(spark, folder):
    fact = I.fact(spark, folder, *_SLA_INPUT, "borough")
    measured = M.measure(fact, ["sla_compliant_count", "sla_breached_count", "sla_compliance"], ["borough_key"])
    return measured.withColumn("sla_compliance", F.round("sla_compliance", 9))


@query("m_sla_allexcept", over(FACT, f"""
SELECT agency_name, borough_key, met AS sla_compliant_count, missed AS sla_breached_count,
  round({fraction("met", "met + missed")}, 9) AS sla_compliance,
  round({fraction("sum(met) OVER (PARTITION BY agency_name)", "(sum(met) OVER (PARTITION BY agency_name) + sum(missed) OVER (PARTITION BY agency_name))")}, 9) AS sla_compliance_by_agency_name
FROM (SELECT agency_name, borough_key, {_MET} AS met, {_MISSED} AS missed FROM fact GROUP BY ALL)"""))
def m_sla_allexcept(spark, folder):
    fact = I.fact(spark, folder, *_SLA_INPUT, "agency_name", "borough")
    result = M.compliance_all_except(fact, "agency_name", ["borough_key"])
    names = ["sla_compliance", "sla_compliance_by_agency_name"]
    return result.withColumns({name: F.round(name, 9) for name in names})


def _age(condition: str) -> str:
    return f"count(*) FILTER (WHERE status = 'Open' AND {condition})"


@query("m_aging_buckets", over(FACT, f"""
SELECT agency_key, {_age("open_request_age_days <= 7")} AS open_0_7,
  {_age("open_request_age_days > 7 AND open_request_age_days <= 30")} AS open_8_30,
  {_age("open_request_age_days > 30 AND open_request_age_days <= 60")} AS open_31_60,
  {_age("open_request_age_days > 60 AND open_request_age_days <= 90")} AS open_61_90,
  {_age("open_request_age_days > 90")} AS open_over_90, {_age("true")} AS open_requests FROM fact GROUP BY 1"""))
def m_aging_buckets(spark, folder):
    return M.aging_buckets(I.fact(spark, folder, "agency", "status"))


@query("m_open_age", over(FACT, """
SELECT agency_key, round(avg(open_request_age_days) FILTER (WHERE status = 'Open'), 6) AS avg_open_request_age,
  count(*) FILTER (WHERE status = 'Open' AND open_request_age_days > 30) AS open_over_30_days FROM fact GROUP BY 1"""))
def m_open_age(spark, folder):
    measured = M.measure(I.fact(spark, folder, "agency", "status"), ["avg_open_request_age", "open_over_30_days"], ["agency_key"])
    return measured.withColumns(I.six("avg_open_request_age"))


@query("m_coord_coverage", over(FACT, """
SELECT borough_key, count(*) FILTER (WHERE has_coordinates) AS requests_with_coords,
  round(count(*) FILTER (WHERE has_coordinates) / CAST(count(*) AS DOUBLE), 9) AS coordinate_coverage FROM fact GROUP BY 1"""))
def m_coord_coverage(spark, folder):
    fact = I.fact(spark, folder, "borough", "latitude", "longitude")
    measured = M.measure(fact, ["requests_with_coords", "coordinate_coverage"], ["borough_key"])
    return measured.withColumn("coordinate_coverage", F.round("coordinate_coverage", 9))


_TARGETS = [1, 7, 30, 45]


@query("m_adjusted_sla", over(FACT, f"""
SELECT agency_key, count(*) FILTER (WHERE status = 'Closed') AS closed_requests, t.target_days,
  count(*) FILTER (WHERE status = 'Closed' AND resolution_days <= t.target_days) AS adjusted_compliant,
  round(count(*) FILTER (WHERE status = 'Closed' AND resolution_days <= t.target_days) / CAST(nullif(count(*) FILTER (WHERE status = 'Closed'), 0) AS DOUBLE), 9) AS adjusted_compliance
FROM fact, (VALUES (1), (7), (30), (45)) AS t(target_days) GROUP BY ALL"""))
def m_adjusted_sla(spark, folder):
    fact = I.fact(spark, folder, "closed_date", "agency", "status")
    adjusted = M.adjusted_compliance(fact, _TARGETS, ["agency_key"])
    return adjusted.withColumn("adjusted_compliance", F.round("adjusted_compliance", 9))


@query("v_kpi_rollup", over(FACT, f"""
SELECT agency_key, borough_key, complaint_category, CAST(grouping(agency_key, borough_key, complaint_category) AS INTEGER) AS level_mask,
  count(*) AS total_requests, {_MET} AS sla_compliant_count, {_MISSED} AS sla_breached_count, round({_FRACTION}, 9) AS sla_compliance,
  {_FRACTION} >= 0.85 AS on_target FROM fact GROUP BY ROLLUP (agency_key, borough_key, complaint_category)"""))
def v_kpi_rollup(spark, folder):
    rolled = M.kpi_rollup(I.fact(spark, folder, *_SLA_INPUT, "borough"), ["agency_key", "borough_key", "complaint_category"])
    return rolled.withColumn("sla_compliance", F.round("sla_compliance", 9))


@query("v_volume_trend", over(FACT, """
SELECT n.period, n.borough_key, n.total_requests, p.total_requests AS requests_py,
  round((n.total_requests - p.total_requests) / CAST(p.total_requests AS DOUBLE), 9) AS yoy_growth
FROM (SELECT CAST(date_trunc('month', created_date_key) AS DATE) AS period, borough_key, count(*) AS total_requests FROM fact GROUP BY ALL) n
LEFT JOIN (SELECT CAST(date_trunc('month', created_date_key) AS DATE) AS period, borough_key, count(*) AS total_requests FROM fact GROUP BY ALL) p
  ON p.borough_key = n.borough_key AND p.period = n.period - INTERVAL 1 YEAR"""))
def v_volume_trend(spark, folder):
    trend = M.volume_trend(I.fact(spark, folder, "borough"), "month", "borough_key")
    return trend.withColumn("yoy_growth", F.round("yoy_growth", 9))


@query("v_agency_table", over(FACT, f"""
SELECT agency_key, count(*) AS total_requests, round(avg(resolution_days) FILTER (WHERE resolution_days > 0), 6) AS avg_resolution_days,
  round({_FRACTION}, 9) AS sla_compliance, count(*) FILTER (WHERE status = 'Open' AND open_request_age_days > 30) AS open_over_30_days,
  {percent("count(*) FILTER (WHERE is_emergency)", "count(*)")} AS emergency_rate_pct FROM fact GROUP BY 1"""))
def v_agency_table(spark, folder):
    listed = M.agency_table(I.fact(spark, folder, *_SLA_INPUT))
    return listed.withColumns(I.six("avg_resolution_days")).withColumn("sla_compliance", F.round("sla_compliance", 9))


@query("v_geo_zip", over(FACT, f"""
SELECT incident_zip, count(*) AS total_requests, round({_FRACTION}, 9) AS sla_compliance FROM fact WHERE has_coordinates GROUP BY 1"""))
def v_geo_zip(spark, folder):
    fact = I.fact(spark, folder, *_SLA_INPUT, "incident_zip", "latitude", "longitude")
    return M.geo_by(fact, "incident_zip").withColumn("sla_compliance", F.round("sla_compliance", 9))


@query("v_geo_cell", over(FACT, f"""
SELECT CAST(floor(round(latitude * 10, 6)) AS INTEGER) AS latitude_cell, CAST(floor(round(longitude * 10, 6)) AS INTEGER) AS longitude_cell,
  count(*) AS total_requests, round({_FRACTION}, 9) AS sla_compliance FROM fact WHERE has_coordinates GROUP BY ALL"""))
def v_geo_cell(spark, folder):
    fact = I.fact(spark, folder, *_SLA_INPUT, "latitude", "longitude")
    return M.geo_cells(fact, 10).withColumn("sla_compliance", F.round("sla_compliance", 9))


@query("v_sla_trend", over(FACT, f"""
SELECT CAST(date_trunc('month', created_date_key) AS DATE) AS period, agency_key, count(*) AS total_requests, {_PCT} AS sla_compliance_pct
FROM fact GROUP BY ALL"""))
def v_sla_trend(spark, folder):
    return M.compliance_trend(I.fact(spark, folder, *_SLA_INPUT), "agency_key")


def _top_sql(source: str) -> str:
    return f"""
SELECT complaint_type, count(*) AS total_requests, {_PCT} AS sla_compliance_pct, round({fraction(_MISSED, f"{_MET} + {_MISSED}")}, 9) AS sla_breach_rate,
  round(avg(resolution_days) FILTER (WHERE resolution_days > 0), 6) AS avg_resolution_days
FROM {source} GROUP BY 1 ORDER BY total_requests DESC, complaint_type LIMIT 10"""


def _top(fact, days=None):
    top = M.top_complaints(fact, 10, days)
    return top.withColumns(I.six("avg_resolution_days")).withColumn("sla_breach_rate", F.round("sla_breach_rate", 9))


@query("top10_complaints", over(FACT, _top_sql("fact")))
def top10_complaints(spark, folder):
    return _top(I.fact(spark, folder, *_SLA_INPUT))


@query("top10_complaints_90d", over(FACT + """,
recent AS (SELECT * FROM fact WHERE created_at >= (SELECT max(created_at) - INTERVAL 90 DAY FROM fact))""", _top_sql("recent")))
def top10_complaints_90d(spark, folder):
    return _top(I.monthly_fact(spark, folder, "created_at", "complaint_type", "sla_compliant", "resolution_days"), 90)


def _days(spark, folder):
    return C.daily_volume(I.fact(spark, folder, "status"))


_DAILY = FACT + CALENDAR + """,
daily AS (SELECT created_date_key AS date_key, count(*) AS total_requests FROM fact GROUP BY 1),
filled AS (SELECT d.date_key, d.year, d.quarter, d.month, coalesce(x.total_requests, 0) AS total_requests
  FROM dim_date d LEFT JOIN daily x ON x.date_key = d.date_key)"""


def _register_to_date(span: str, keys: str) -> None:
    @query(f"requests_{span}", over(_DAILY, f"""
SELECT date_key, year, quarter, month, total_requests, CAST(sum(total_requests) OVER (PARTITION BY {keys} ORDER BY date_key) AS BIGINT) AS requests_{span} FROM filled"""))
    def run(spark, folder):
        return C.to_date_total(C.on_calendar(_days(spark, folder), D.dim_date(spark)), span)


_register_to_date("mtd", "year, month")
_register_to_date("qtd", "year, quarter")
_register_to_date("ytd", "year")


@query("requests_py", over(_DAILY, """
SELECT n.date_key, n.total_requests, p.total_requests AS requests_py,
  round((n.total_requests - p.total_requests) / CAST(p.total_requests AS DOUBLE), 9) AS yoy_growth
FROM daily n LEFT JOIN daily p ON p.date_key = CAST(n.date_key - INTERVAL 1 YEAR AS DATE)"""))
def requests_py(spark, folder):
    return C.prior_year(_days(spark, folder)).withColumn("yoy_growth", F.round("yoy_growth", 9))


@query("yoy_growth", over(_DAILY, """
SELECT n.year, n.month, n.total_requests, p.total_requests AS requests_py, round((n.total_requests - p.total_requests) / CAST(p.total_requests AS DOUBLE), 9) AS yoy_growth
FROM (SELECT CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM daily GROUP BY ALL) n
LEFT JOIN (SELECT CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM daily GROUP BY ALL) p
  ON p.year = n.year - 1 AND p.month = n.month"""))
def yoy_growth(spark, folder):
    return C.monthly_prior_year(_days(spark, folder)).withColumn("yoy_growth", F.round("yoy_growth", 9))


@query("rolling_7d_avg", over(_DAILY, """
SELECT date_key, total_requests, round(avg(total_requests) OVER (ORDER BY date_key RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 6) AS rolling_7d_avg FROM daily"""))
def rolling_7d_avg(spark, folder):
    return C.rolling_average(_days(spark, folder)).withColumns(I.six("rolling_7d_avg"))


@query("rolling_7d_avg_by_borough", over(FACT, """
SELECT date_key, borough_key, total_requests,
  round(avg(total_requests) OVER (PARTITION BY borough_key ORDER BY date_key RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 6) AS rolling_7d_avg
FROM (SELECT created_date_key AS date_key, borough_key, count(*) AS total_requests FROM fact GROUP BY ALL)"""))
def rolling_7d_avg_by_borough(spark, folder):
    days = C.daily_volume(I.fact(spark, folder, "borough"), ["borough_key"])
    return C.rolling_average(days, by=["borough_key"]).withColumns(I.six("rolling_7d_avg"))


@query("last_n_days", over(FACT, """
SELECT agency_key, count(*) AS total_requests FROM fact
WHERE created_date_key >= (SELECT max(created_date_key) - 30 FROM fact) GROUP BY 1"""))
def last_n_days(spark, folder):
    return C.last_n_days(I.monthly_fact(spark, folder), 30, ["agency_key"])
