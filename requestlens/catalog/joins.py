"""Policy joins, dimension joins and the fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog import oracle as O
from requestlens.catalog.ingest import _FACT_SQL
from requestlens.catalog.oracle import CALENDAR, DIMS, ENRICHED, FACT, STAGED, over
from requestlens.catalog.registry import query
from requestlens.functions import standardize as S
from requestlens.operators import policies as P
from requestlens.plans import calendar as C
from requestlens.plans import checks as K
from requestlens.plans import dimensions as D
from requestlens.plans import fact as T
from requestlens.plans import marts as M
from requestlens.session import store
from requestlens.sources.seeds import policy_frame

c = F.col

# The seed plus rows with a wildcard type and with descriptors, so that every level of a match occurs in the data.
LAYERED_POLICIES = V.SLA_POLICIES[:-1] + [
    ("DSNY", "*", None, 9, False),
    ("DSNY", "*", "Brand#7", 8, False),
    ("NYPD", "Illegal Parking", "Brand#3", 4, False),
    ("NYPD", "Illegal Parking", "*", 6, False),
    ("OATH", "*", "*", 45, False),
    ("*", "*", None, 30, False),
]
_SLA_INPUT = ["agency", "complaint_type", "descriptor"]
_MATCH = """p.agency = s.agency_code AND (p.complaint_type = s.complaint_type OR p.complaint_type = '*')
  AND (p.descriptor IS NULL OR p.descriptor = s.descriptor OR p.descriptor = '*')"""


@query("sla_join_all", over(STAGED, f"""
SELECT s.unique_key, s.agency_code, s.complaint_type, s.descriptor, CAST(coalesce(p.sla_days, 30) AS INTEGER) AS sla_days
FROM stg s LEFT JOIN {O.policies(LAYERED_POLICIES)} ON {_MATCH}"""))
def sla_join_all(spark, folder):
    rows = I.staged(spark, folder, *_SLA_INPUT).select("unique_key", "agency_code", "complaint_type", "descriptor")
    return P.with_all_policies(rows, policy_frame(spark, LAYERED_POLICIES))


@query("sla_join_best", over(STAGED, f"""
SELECT unique_key, agency_code, complaint_type, descriptor, CAST(coalesce(sla_days, 30) AS INTEGER) AS sla_days FROM (
  SELECT s.unique_key, s.agency_code, s.complaint_type, s.descriptor, p.sla_days,
    row_number() OVER (PARTITION BY s.unique_key ORDER BY (p.complaint_type = '*'), (coalesce(p.descriptor, '*') = '*'), p.policy_no) AS rn
  FROM stg s LEFT JOIN {O.policies(LAYERED_POLICIES)} ON {_MATCH}) WHERE rn = 1"""))
def sla_join_best(spark, folder):
    rows = I.staged(spark, folder, *_SLA_INPUT).select("unique_key", "agency_code", "complaint_type", "descriptor")
    return P.with_best_policy(rows, policy_frame(spark, LAYERED_POLICIES))


_ORDERED = [
    ("NYPD", "Illegal Parking", "Brand#3", 4, False),
    ("NYPD", "Illegal Parking", None, 6, False),
    ("NYPD", "Illegal Parking", "Brand#5", 2, False),
] + V.LOOKUP_POLICIES
_STD = "CASE " + " ".join(
    f"WHEN upper(trim(r.agency)) = '{name}' THEN '{code}'" for name, code in V.AGENCY_ALIASES.items()
) + " ELSE upper(trim(r.agency)) END"


@query("sla_lookup_first", over(O.CURRENT, f"""
SELECT unique_key, std AS agency, complaint_type, descriptor, CAST(coalesce(sla_days, 30) AS INTEGER) AS sla_days FROM (
  SELECT r.unique_key, {_STD} AS std, r.complaint_type, r.descriptor, p.sla_days,
    row_number() OVER (PARTITION BY r.unique_key ORDER BY p.policy_no) AS rn
  FROM cur r LEFT JOIN {O.policies(_ORDERED)} ON p.agency = {_STD} AND p.complaint_type = r.complaint_type
    AND (p.descriptor IS NULL OR p.descriptor = r.descriptor)) WHERE rn = 1"""))
def sla_lookup_first(spark, folder):
    rows = I.current(spark, folder, *_SLA_INPUT).select(
        "unique_key", S.agency(c("agency")).alias("agency"), "complaint_type", "descriptor"
    )
    return P.with_first_policy(rows, policy_frame(spark, _ORDERED), "agency")


def _narrow(spark, folder, *columns):
    """Enriched rows reduced to a few columns and stored, since dimension and fact both read them."""
    raw = {
        "agency_code": "agency", "agency_name": "agency_name", "complaint_type": "complaint_type",
        "descriptor": "descriptor", "borough": "borough",
    }
    rows = I.staged(spark, folder, *[raw[name] for name in columns])
    return store(rows.select("unique_key", "created_at", *columns), "requests")


@query("fact_agency_join", over(STAGED + DIMS, """
SELECT a.agency_key, a.agency_name AS dim_name, a.agency_domain, s.agency_code, count(*) AS requests
FROM stg s LEFT JOIN dim_agency a ON a.agency_key = s.agency_code GROUP BY ALL"""))
def fact_agency_join(spark, folder):
    rows = _narrow(spark, folder, "agency_code", "agency_name")
    dims = I.stored_dims(rows, "agency")
    dim = dims["agency"].withColumnRenamed("agency_name", "dim_name")
    joined = T.join_agency(rows, dim, ("agency_key", "dim_name", "agency_domain"))
    return joined.groupBy("agency_key", "dim_name", "agency_domain", "agency_code").agg(F.count("*").alias("requests"))


@query("fact_complaint_join", over(STAGED + DIMS, """
SELECT s.unique_key, d.complaint_type_key, s.complaint_type, s.descriptor FROM stg s
LEFT JOIN dim_complaint d ON d.complaint_type = s.complaint_type AND d.descriptor IS NOT DISTINCT FROM s.descriptor"""))
def fact_complaint_join(spark, folder):
    rows = _narrow(spark, folder, "complaint_type", "descriptor")
    joined = T.join_complaint(rows, I.stored_dims(rows, "complaint_type")["complaint_type"])
    return joined.select("unique_key", "complaint_type_key", "complaint_type", "descriptor")


@query("fact_complaint_join_all", over(STAGED + DIMS, """
SELECT s.complaint_type, count(DISTINCT s.unique_key) AS requests, count(*) AS joined_rows FROM stg s
LEFT JOIN dim_complaint d ON d.complaint_type = s.complaint_type
  AND (d.descriptor = s.descriptor OR d.descriptor IS NULL OR s.descriptor IS NULL) GROUP BY 1"""))
def fact_complaint_join_all(spark, folder):
    """How far the null-tolerant match multiplies the requests of each type."""
    rows = _narrow(spark, folder, "complaint_type", "descriptor")
    return T.complaint_matches(rows, I.stored_dims(rows, "complaint_type")["complaint_type"])


@query("fact_borough_join", over(STAGED + DIMS, """
SELECT b.borough_key, s.borough, count(*) AS requests FROM stg s LEFT JOIN dim_borough b ON b.borough_key = s.borough GROUP BY ALL"""))
def fact_borough_join(spark, folder):
    rows = _narrow(spark, folder, "borough")
    joined = T.join_borough(rows, I.stored_dims(rows, "borough")["borough"])
    return joined.groupBy("borough_key", "borough").agg(F.count("*").alias("requests"))


@query("fact_date_join", over(FACT + CALENDAR, """
SELECT d.year, d.quarter, d.month, count(*) AS requests FROM fact f JOIN dim_date d ON d.date_key = f.created_date_key GROUP BY ALL"""))
def fact_date_join(spark, folder):
    days = C.daily_volume(I.fact(spark, folder, "status"))
    joined = days.join(D.dim_date(spark), "date_key")
    return joined.groupBy("year", "quarter", "month").agg(F.sum("total_requests").alias("requests"))


@query("closed_volume_by_month", over(FACT + CALENDAR, """
SELECT coalesce(o.year, x.year) AS year, coalesce(o.month, x.month) AS month, coalesce(created_requests, 0) AS created_requests,
  coalesce(closed_requests, 0) AS closed_requests
FROM (SELECT year, month, count(*) AS created_requests FROM fact JOIN dim_date ON date_key = created_date_key GROUP BY ALL) o
FULL JOIN (SELECT year, month, count(*) AS closed_requests FROM fact JOIN dim_date ON date_key = closed_date_key GROUP BY ALL) x
  ON o.year = x.year AND o.month = x.month"""))
def closed_volume_by_month(spark, folder):
    days = store(I.fact(spark, folder, "closed_date").select("created_date_key", "closed_date_key"), "fact")
    return C.closed_volume(days, D.dim_date(spark))


@query("q_relationships", over(FACT + CALENDAR, """
SELECT 'agency' AS reference, count(*) AS lost FROM fact WHERE agency_code IS NOT NULL AND agency_code NOT IN (SELECT agency_key FROM dim_agency WHERE agency_domain <> 'Other')
UNION ALL SELECT 'borough', count(*) FROM fact WHERE borough_key NOT IN (SELECT borough_key FROM dim_borough WHERE borough_sort_order > 0)
UNION ALL SELECT 'created_date', count(*) FROM fact WHERE created_date_key NOT IN (SELECT date_key FROM dim_date WHERE year < 2027)
UNION ALL SELECT 'closed_date', count(*) FROM fact WHERE closed_date_key IS NOT NULL AND closed_date_key NOT IN (SELECT date_key FROM dim_date WHERE year < 2027)"""))
def q_relationships(spark, folder):
    """Rows whose key is absent from deliberately narrowed dimensions."""
    columns = ["agency_code", "agency_name", "borough", "borough_key", "created_date_key", "closed_date_key"]
    rows = I.stored_fact(spark, folder, *columns)
    dims = I.stored_dims(rows, "agency", "borough")
    days = D.dim_date(spark).where(c("year") < 2027)
    wanted = [
        ("agency", "agency_code", dims["agency"].where(c("agency_domain") != V.OTHER_DOMAIN), "agency_key"),
        ("borough", "borough_key", dims["borough"].where(c("borough_sort_order") > 0), "borough_key"),
        ("created_date", "created_date_key", days, "date_key"),
        ("closed_date", "closed_date_key", days, "date_key"),
    ]
    result = None
    for name, column, dim, field in wanted:
        lost = K.missing_references(rows, column, dim, field).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("lost"))
        lost = lost.select(F.lit(name).alias("reference"), "lost")
        result = lost if result is None else result.unionByName(lost)
    return result


@query("rolling_90d", over(FACT, """
SELECT agency_code, status, count(*) AS requests FROM fact
WHERE created_at >= (SELECT max(created_at) - INTERVAL 90 DAY FROM fact) GROUP BY ALL"""))
def rolling_90d(spark, folder):
    rows = M.last_days(I.monthly_fact(spark, folder, "created_at", "agency_code", "status"), 90)
    return rows.groupBy("agency_code", "status").agg(F.count("*").alias("requests"))


@query("fact_service_requests", over(FACT, f"SELECT {_FACT_SQL} FROM fact"))
def fact_service_requests(spark, folder):
    """The fact joined with its stored dimensions."""
    used = [
        "unique_key", "created_date_key", "closed_date_key", "agency_code", "agency_name", "complaint_type", "descriptor",
        "complaint_category", "borough", "incident_zip", "status", "location_type", "resolution_days", "sla_days",
        "sla_compliant", "open_request_age_days", "is_emergency", "has_coordinates", "latitude", "longitude",
        "created_at", "closed_at", "dbt_updated_at",
    ]
    requests = store(I.enriched(spark, folder, *I.FACT_INPUT).select(*used), "enriched")
    return T.build_fact(requests, I.stored_dims(requests)).drop("dbt_updated_at")
