"""Monitors over requests and over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog import oracle as O
from requestlens.catalog.oracle import FACT, FIT, RAW, over
from requestlens.catalog.registry import query
from requestlens.functions.temporal import parse_datetime
from requestlens.operators.cursor import created_at
from requestlens.plans import monitors as M
from requestlens.schemas import API_FIELDS
from requestlens.session import store
from requestlens.sources.landing import with_payload
from requestlens.sources.star_requests import AS_OF, RULES
from requestlens.sources.tables import TABLES, table

c = F.col


def _scored_sql(source: str, day: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    span = f"({part}ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    return f"""
SELECT {key}day, row_count, round(mean, 6) AS mean_30d, round(sd, 6) AS stddev_30d, round((row_count - mean) / nullif(sd, 0), 6) AS z_score,
  coalesce(abs((row_count - mean) / nullif(sd, 0)) > {V.ROW_COUNT_SIGMAS}, false) AS is_anomaly
FROM (SELECT {key}day, row_count, avg(row_count) OVER {span} AS mean, stddev_samp(row_count) OVER {span} AS sd
  FROM (SELECT {key}{day} AS day, count(*) AS row_count FROM {source} GROUP BY ALL))"""


def _daily(spark, folder):
    rows = I.fit(spark, folder)
    return M.daily_counts(rows, F.to_date(created_at()))


@query("mon_rowcount_zscore", over(FIT, _scored_sql("fit", "CAST(created_at AS DATE)")))
def mon_rowcount_zscore(spark, folder):
    return M.row_count_anomalies(_daily(spark, folder)).withColumns(I.six("mean_30d", "stddev_30d", "z_score"))


@query("mon_rowcount_zscore_events", "SELECT * FROM (" + _scored_sql("events", "CAST(ts AS DATE)", "event_type") + ")")
def mon_rowcount_zscore_events(spark, folder):
    daily = M.daily_counts(table(spark, folder, "events"), F.to_date("ts"), ["event_type"])
    return M.row_count_anomalies(daily, ["event_type"]).withColumns(I.six("mean_30d", "stddev_30d", "z_score"))


@query("mon_rowcount_drop", over(FIT, """
SELECT day, row_count, before AS previous_count, round(row_count / CAST(before AS DOUBLE) - 1, 6) AS change,
  coalesce(row_count / CAST(before AS DOUBLE) - 1 < -0.5, false) AS is_drop
FROM (SELECT day, row_count, lag(row_count) OVER (ORDER BY day) AS before
  FROM (SELECT CAST(created_at AS DATE) AS day, count(*) AS row_count FROM fit GROUP BY 1))"""))
def mon_rowcount_drop(spark, folder):
    return M.row_count_drops(_daily(spark, folder)).withColumns(I.six("change"))


_WATCHED = [name for name in RULES if name not in ("unique_key", "source_row")]


@query("mon_null_rate", over(FIT, f"""
SELECT day, column_name, round(null_rate, 6) AS null_rate, round(base, 6) AS baseline_rate,
  round(100 * (null_rate - base), 6) AS increase_points, coalesce(round(100 * (null_rate - base), 6) > {V.NULL_RATE_INCREASE_POINTS}, false) AS is_increase
FROM (SELECT *, avg(null_rate) OVER (PARTITION BY column_name ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS base
  FROM ({" UNION ALL ".join(f"SELECT CAST(created_at AS DATE) AS day, '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) / CAST(count(*) AS DOUBLE) AS null_rate FROM fit GROUP BY 1" for name in _WATCHED)}))"""))
def mon_null_rate(spark, folder):
    rates = M.null_rates(I.fit(spark, folder, *_WATCHED), F.to_date(created_at()), _WATCHED)
    return M.null_rate_increases(rates).withColumns(I.six("null_rate", "baseline_rate"))


@query("mon_freshness", over(FIT, f"""
SELECT max(created_at) AS newest, round(date_diff('microsecond', max(created_at), TIMESTAMP '{AS_OF}') / 3600e6, 6) AS age_hours,
  date_diff('microsecond', max(created_at), TIMESTAMP '{AS_OF}') / 3600e6 <= 24 AS is_fresh FROM fit"""))
def mon_freshness(spark, folder):
    return M.freshness(I.with_time(I.fit(spark, folder)), "created_at", AS_OF).withColumns(I.six("age_hours"))


@query("mon_source_freshness", over(RAW, f"""
SELECT max(ingested_at) AS newest, round(date_diff('microsecond', max(ingested_at), TIMESTAMP '{AS_OF}') / 3600e6, 6) AS age_hours,
  CASE WHEN date_diff('microsecond', max(ingested_at), TIMESTAMP '{AS_OF}') / 3600e6 <= 24 THEN 'pass'
    WHEN date_diff('microsecond', max(ingested_at), TIMESTAMP '{AS_OF}') / 3600e6 <= 48 THEN 'warn' ELSE 'error' END AS status FROM raw"""))
def mon_source_freshness(spark, folder):
    return M.source_freshness(I.raw(spark, folder, "ingested_at"), AS_OF).withColumns(I.six("age_hours"))


@query("mon_completeness", over(RAW, " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) AS row_count, count({name}) AS non_null_count, "
    f"round(count({name}) / CAST(count(*) AS DOUBLE), 6) AS completeness, count({name}) / CAST(count(*) AS DOUBLE) >= {V.CRITICAL_COMPLETENESS} AS is_complete FROM raw"
    for name in V.CRITICAL_COLUMNS)))
def mon_completeness(spark, folder):
    return M.completeness(I.raw(spark, folder, *V.CRITICAL_COLUMNS)).withColumns(I.six("completeness"))


_PAYLOAD = ["unique_key", "created_date", "closed_date", "agency", "borough", "incident_zip", "status", "source_row"]
_CONTRACT = ["unique_key", "created_date", "closed_date", "agency", "borough", "incident_zip", "status", "city"]


@query("mon_schema_drift", over(RAW, f"""
SELECT coalesce(f.field, x.field) AS field, coalesce(records, 0) AS records,
  CASE WHEN x.field IS NULL THEN 'unknown' WHEN f.field IS NULL THEN 'missing' ELSE 'known' END AS status
FROM (SELECT * FROM ({" UNION ALL ".join(f"SELECT '{name}' AS field, count({name}) AS records FROM raw" for name in _PAYLOAD)}) WHERE records > 0) f
FULL JOIN (SELECT unnest({O._list(_CONTRACT)}) AS field) x ON x.field = f.field"""))
def mon_schema_drift(spark, folder):
    """Fields found in the raw rows' JSON payloads against a contract that lacks one of them and names another."""
    rows = I.raw(spark, folder, *_PAYLOAD)
    payload = rows.select(F.to_json(F.struct(*_PAYLOAD)).alias("raw_payload"))
    return M.schema_drift(M.payload_fields(payload), _CONTRACT)


@query("mon_schema_drift_events", """
SELECT coalesce(f.field, x.field) AS field, coalesce(records, 0) AS records,
  CASE WHEN x.field IS NULL THEN 'unknown' WHEN f.field IS NULL THEN 'missing' ELSE 'known' END AS status
FROM (SELECT field, count(*) AS records FROM (SELECT unnest(json_keys(props)) AS field FROM events) GROUP BY 1) f
FULL JOIN (SELECT unnest(['k', 'page']) AS field) x ON x.field = f.field""")
def mon_schema_drift_events(spark, folder):
    return M.schema_drift(M.payload_fields(table(spark, folder, "events"), "props"), ["k", "page"])


@query("mon_uncastable", over(RAW, f"""
SELECT 'created_date' AS column_name, count(created_date) AS "values", count(*) FILTER (WHERE created_date IS NOT NULL AND ({O.parse_time("created_date")}) IS NULL) AS uncastable FROM raw
UNION ALL SELECT 'closed_date', count(closed_date), count(*) FILTER (WHERE closed_date IS NOT NULL AND ({O.parse_time("closed_date")}) IS NULL) FROM raw
UNION ALL SELECT 'incident_zip', count(incident_zip), count(*) FILTER (WHERE incident_zip IS NOT NULL AND TRY_CAST(incident_zip AS INTEGER) IS NULL) FROM raw
UNION ALL SELECT 'latitude', count(latitude), count(*) FILTER (WHERE latitude IS NOT NULL AND TRY_CAST(latitude AS DOUBLE) IS NULL) FROM raw"""))
def mon_uncastable(spark, folder):
    casts = {
        "created_date": parse_datetime(c("created_date")),
        "closed_date": parse_datetime(c("closed_date")),
        "incident_zip": c("incident_zip").try_cast("int"),
        "latitude": c("latitude").try_cast("double"),
    }
    return M.uncastable(I.raw(spark, folder, *casts), casts)


_PROFILED = list(RULES)


def _profile_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count, "
        f"count(DISTINCT {name}) AS distinct_count, min(CAST({name} AS VARCHAR)) AS min_value, max(CAST({name} AS VARCHAR)) AS max_value FROM {source}"
        for name in columns
    )


@query("profile_columns", over(RAW, _profile_sql("raw", _PROFILED)))
def profile_columns(spark, folder):
    return M.profile(store(I.raw(spark, folder, *_PROFILED), "profiled"), exact=True)


_EVENTS = "(SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(value AS DECIMAL(30, 6)) AS value) FROM events)"


@query("profile_events", _profile_sql(_EVENTS, TABLES["events"].replace(",", "").split()[::2]))
def profile_events(spark, folder):
    """Instants and doubles are profiled in a fixed layout, since engines write them differently."""
    events = table(spark, folder, "events")
    return M.profile(
        events.withColumns({"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "value": F.col("value").cast("decimal(30,6)")}), exact=True
    )


_LEGAL = ", ".join(f"('{a}', '{b}')" for a, b in V.STATUS_CHANGES)


@query("mon_status_transitions", over(FIT, f"""
SELECT before AS from_status, status AS to_status, (before, status) IN ({_LEGAL}) AS is_legal, count(*) AS changes FROM (
  SELECT status, lag(status) OVER (PARTITION BY unique_key ORDER BY ingested_at, source_row, status) AS before
  FROM (SELECT DISTINCT unique_key, ingested_at, source_row, status FROM fit))
WHERE before IS DISTINCT FROM status AND before IS NOT NULL GROUP BY ALL"""))
def mon_status_transitions(spark, folder):
    """Versions of one request in landing order."""
    rows = I.fit(spark, folder, "status").select("unique_key", "ingested_at", "source_row", "status")
    return M.illegal_status_changes(M.status_changes(rows))
