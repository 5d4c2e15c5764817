"""Daily, monthly and 90-day performance marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.functions.numeric import percent, rounded
from requestlens.operators.quantiles import aggregate_with_quantile

DAILY_KEYS = ["date_key", "agency_code", "agency_name", "borough", "complaint_category"]


def compliance_columns(name: str = "sla_compliance_rate") -> list:
    met, missed = F.count_if(F.col("sla_compliant")), F.count_if(~F.col("sla_compliant"))
    return [
        met.alias("sla_compliant_count"),
        missed.alias("sla_breached_count"),
        percent(met, F.count("sla_compliant")).alias(name),
    ]


def _status_counts(total: str, closed: str, open_: str) -> list:
    status = F.col("status")
    return [
        F.count("*").alias(total),
        F.count_if(status == "Closed").alias(closed),
        F.count_if(status == "Open").alias(open_),
    ]


def _aggregate(rows: DataFrame, keys: list[str], columns: list, median: bool) -> DataFrame:
    if not median:
        return rows.groupBy(*keys).agg(*columns)
    return aggregate_with_quantile(rows, keys, columns, "resolution_days", "median_resolution_days")


def daily_agency_metrics(enriched: DataFrame, median: bool = True) -> DataFrame:
    """Requests per day, agency, borough and category. ``enriched`` should be a stored table when ``median`` is on."""
    rows = enriched.withColumnRenamed("created_date_key", "date_key")
    columns = [
        *_status_counts("request_count", "closed_count", "open_count"),
        F.avg("resolution_days").alias("avg_resolution_days"),
        *compliance_columns(),
        F.avg("open_request_age_days").alias("avg_open_request_age_days"),
    ]
    return _aggregate(rows, DAILY_KEYS, columns, median)


def monthly_borough_performance(
    fact: DataFrame, dates: DataFrame, boroughs: DataFrame, median: bool = True
) -> DataFrame:
    """Requests per calendar month and borough, for days that the calendar contains."""
    calendar = dates.select(F.col("date_key").alias("created_date_key"), "year", "month", "quarter")
    places = boroughs.select("borough_key", "borough_name", "county_name")
    rows = fact.join(calendar, "created_date_key").join(places, "borough_key", "left")
    keys = ["year", "month", "quarter", "borough_key", "borough_name", "county_name"]
    columns = [
        *_status_counts("total_requests", "closed_requests", "open_requests"),
        rounded(F.avg("resolution_days")).alias("avg_resolution_days"),
        *compliance_columns("sla_compliance_rate_pct"),
        rounded(F.avg("open_request_age_days")).alias("avg_open_request_age_days"),
    ]
    monthly = _aggregate(rows, keys, columns, median)
    if median:
        monthly = monthly.withColumn("median_resolution_days", rounded(F.col("median_resolution_days")))
    return monthly.orderBy("year", "month", "borough_key")


def newest_month(rows: DataFrame, month: str) -> DataFrame:
    """The rows of the newest month of a table stored by month; no other folder is read."""
    return rows.where(F.col(month) == rows.agg(F.max(month)).scalar())


def last_days(fact: DataFrame, days: int, column: str = "created_at", month: str = "created_month_key") -> DataFrame:
    """Rows of the last ``days`` days before the newest one; the bound is a scalar subquery.

    Where the table is stored by month, the bound comes from the newest month, and only the months from it on are read.
    """
    span = F.make_dt_interval(F.lit(days))
    if month not in fact.columns:
        return fact.where(F.col(column) >= fact.agg(F.max(column) - span).scalar())
    newest = newest_month(fact, month)
    first_month = newest.agg(F.trunc((F.max(column) - span).cast("date"), "MONTH")).scalar()
    return fact.where((F.col(month) >= first_month) & (F.col(column) >= newest.agg(F.max(column) - span).scalar()))


def agency_sla_scorecard(fact: DataFrame, agencies: DataFrame, days: int = 90, median: bool = True) -> DataFrame:
    """Agency performance over the last ``days`` days, worst compliance first."""
    domains = agencies.select(F.col("agency_key").alias("_agency"), "agency_domain")
    rows = last_days(fact, days).join(domains, F.col("_agency") == F.col("agency_key"), "left").drop("_agency")
    keys = ["agency_key", "agency_name", "agency_domain"]
    columns = [
        *_status_counts("total_requests_90d", "closed_requests_90d", "open_requests_90d"),
        rounded(F.avg("resolution_days")).alias("avg_resolution_days"),
        *compliance_columns("sla_compliance_rate_pct"),
        F.mode("complaint_category", True).alias("top_complaint_category"),
        percent(F.count_if("is_emergency"), F.count("*")).alias("emergency_request_rate_pct"),
    ]
    card = _aggregate(rows, keys, columns, median)
    if median:
        card = card.withColumn("median_resolution_days", rounded(F.col("median_resolution_days")))
    return card.orderBy(F.asc_nulls_last("sla_compliance_rate_pct"), "agency_key", "agency_name")
