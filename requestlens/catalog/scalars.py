"""Standardisers and scalar rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog import oracle as O
from requestlens.catalog.oracle import ENRICHED, RAW, STAGED, over
from requestlens.catalog.registry import query
from requestlens.functions import rules as R
from requestlens.functions import standardize as S
from requestlens.functions import temporal as D
from requestlens.functions.numeric import surrogate_key
from requestlens.plans.dimensions import dim_date_spanning
from requestlens.plans.staging import staged_requests, transformed_records
from requestlens.sources.seeds import policy_frame
from requestlens.sources.star_requests import AS_OF

c = F.col
def _n():
    return F.count("*").alias("requests")



@query("parse_datetime", over(RAW, f"""
SELECT unique_key, source_row, created_date, {O.parse_time("created_date")} AS created_at, {O.parse_time("closed_date")} AS closed_at FROM raw"""))
def parse_datetime(spark, folder):
    rows = I.raw(spark, folder, "unique_key", "source_row", "created_date", "closed_date")
    return rows.select(
        "unique_key", "source_row", "created_date", D.parse_datetime(c("created_date")).alias("created_at"),
        D.parse_datetime(c("closed_date")).alias("closed_at"),
    )


@query("parse_datetime_numbers", over(STAGED, """
SELECT unique_key, created_at, closed_at FROM stg"""))
def parse_datetime_numbers(spark, folder):
    """Times that come as numbers, milliseconds since 1970, through the staged projection."""
    rows = I.current(spark, folder, "closed_date")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")

    def millis(name):
        instant = D.parse_datetime(F.nullif(F.trim(name), F.lit("")))
        return F.floor(F.timestamp_diff("MICROSECOND", epoch, instant) / 1000).alias(name)

    numbers = rows.select("unique_key", "ingested_at", millis("created_date"), millis("closed_date"))
    return staged_requests(numbers).select("unique_key", "created_at", "closed_at")


@query("stg_text_clean", over(RAW, """
SELECT upper(trim(agency)) AS agency_code, trim(agency_name) AS agency_name, trim(complaint_type) AS complaint_type,
  upper(trim(location_type)) AS location_type, trim(status) AS status, count(*) AS requests
FROM raw WHERE unique_key IS NOT NULL GROUP BY ALL"""))
def stg_text_clean(spark, folder):
    names = ["agency_code", "agency_name", "complaint_type", "location_type", "status"]
    rows = I.raw(spark, folder, "unique_key", "agency", "agency_name", "complaint_type", "location_type", "status")
    return staged_requests(rows).groupBy(*names).agg(_n())


@query("std_borough", over(RAW, f"SELECT borough, {O.borough('borough')} AS standard, count(*) AS requests FROM raw GROUP BY ALL"))
def std_borough(spark, folder):
    rows = I.raw(spark, folder, "borough")
    return rows.groupBy("borough", S.borough(c("borough")).alias("standard")).agg(_n())


_AGENCY_SQL = "CASE " + " ".join(
    f"WHEN upper(trim(agency)) = '{name}' THEN '{code}'" for name, code in V.AGENCY_ALIASES.items()
) + " ELSE upper(trim(agency)) END"


@query("std_agency", over(RAW, f"SELECT agency, {_AGENCY_SQL} AS standard, count(*) AS requests FROM raw GROUP BY ALL"))
def std_agency(spark, folder):
    rows = I.raw(spark, folder, "agency")
    return rows.groupBy("agency", S.agency(c("agency")).alias("standard")).agg(_n())


@query("stg_agency_code", over(RAW, """
SELECT agency, upper(trim(agency)) AS agency_code, count(*) AS requests FROM raw WHERE unique_key IS NOT NULL GROUP BY ALL"""))
def stg_agency_code(spark, folder):
    rows = I.raw(spark, folder, "unique_key", "agency").where(c("unique_key").isNotNull())
    return rows.groupBy("agency", S.upper_trim(c("agency")).alias("agency_code")).agg(_n())


@query("clean_zip", over(RAW, f"""
SELECT incident_zip, CASE WHEN regexp_matches(incident_zip, '^[0-9]{{5}}') AND CAST(left(incident_zip, 5) AS INTEGER)
  BETWEEN {V.ZIP_LOW} AND {V.ZIP_HIGH} THEN left(incident_zip, 5) END AS zip, count(*) AS requests FROM raw GROUP BY ALL"""))
def clean_zip(spark, folder):
    rows = I.raw(spark, folder, "incident_zip")
    return rows.groupBy("incident_zip", S.zip_code(c("incident_zip")).alias("zip")).agg(_n())


@query("zip_digits", over(RAW, """
SELECT incident_zip, regexp_replace(incident_zip, '[^0-9]', '', 'g') AS zip, count(*) AS requests FROM raw GROUP BY ALL"""))
def zip_digits(spark, folder):
    rows = I.raw(spark, folder, "incident_zip")
    return rows.groupBy("incident_zip", S.zip_digits(c("incident_zip")).alias("zip")).agg(_n())


@query("stg_closed_at", over(RAW, f"""
SELECT unique_key, source_row, {O.parse_time("nullif(trim(closed_date), '')")} AS closed_at FROM raw WHERE unique_key IS NOT NULL"""))
def stg_closed_at(spark, folder):
    rows = I.raw(spark, folder, "unique_key", "source_row", "closed_date").where(c("unique_key").isNotNull())
    closed = D.parse_datetime(F.nullif(F.trim("closed_date"), F.lit("")))
    return rows.select("unique_key", "source_row", closed.alias("closed_at"))


@query("stg_casts", over(STAGED, "SELECT unique_key, created_at, closed_at, latitude, longitude FROM stg"))
def stg_casts(spark, folder):
    return I.staged(spark, folder, "closed_date", "latitude", "longitude").select(
        "unique_key", "created_at", "closed_at", "latitude", "longitude"
    )


@query("stg_key_filter", over(RAW, """
SELECT status, count(*) AS requests, count(DISTINCT unique_key) AS keys FROM raw WHERE unique_key IS NOT NULL GROUP BY 1"""))
def stg_key_filter(spark, folder):
    rows = staged_requests(I.raw(spark, folder, "unique_key", "status"))
    counted = rows.groupBy("status", "unique_key").agg(F.count("*").alias("n"))
    return counted.groupBy("status").agg(F.sum("n").alias("requests"), F.count("*").alias("keys"))


@query("parse_location", over(RAW, """
SELECT unique_key, source_row,
  CASE WHEN json_valid(location) THEN json_extract_string(location, '$.type') END AS location_type,
  CASE WHEN json_valid(location) THEN TRY_CAST(json_extract_string(location, '$.coordinates[0]') AS DOUBLE) END AS lon,
  CASE WHEN json_valid(location) THEN TRY_CAST(json_extract_string(location, '$.coordinates[1]') AS DOUBLE) END AS lat
FROM raw"""))
def parse_location(spark, folder):
    place = S.location(c("location"))
    rows = I.raw(spark, folder, "unique_key", "source_row", "location").withColumn("p", place)
    return rows.select(
        "unique_key", "source_row", c("p.type").alias("location_type"),
        F.get("p.coordinates", 0).alias("lon"), F.get("p.coordinates", 1).alias("lat"),
    )


@query("resolution_days", over(ENRICHED, "SELECT unique_key, resolution_days FROM enr"))
def resolution_days(spark, folder):
    return I.enriched(spark, folder, "closed_date").select("unique_key", "resolution_days")


@query("resolution_days_strict", over(ENRICHED, "SELECT unique_key, CASE WHEN resolution_days >= 0 THEN resolution_days END AS resolution_days FROM enr"))
def resolution_days_strict(spark, folder):
    strict = D.resolution_days(c("created_at"), c("closed_at"), strict=True)
    return I.staged(spark, folder, "closed_date").select("unique_key", strict.alias("resolution_days"))


_HOLIDAYS = ["2021-07-05", "2022-07-04", "2023-07-04", "2023-12-25", "2024-01-01", "2024-07-04", "2025-12-25", "2026-01-01"]


@query("business_days", over(STAGED, f"""
SELECT unique_key, CASE WHEN closed_at >= created_at THEN
  CAST(len(list_filter(range(CAST(created_at AS DATE), CAST(closed_at AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY),
    lambda d: isodow(d) < 6 AND NOT list_contains([{", ".join(f"DATE '{d}'" for d in _HOLIDAYS)}], CAST(d AS DATE)))) AS INTEGER) END AS business_days
FROM stg"""))
def business_days(spark, folder):
    days = D.business_days(c("created_at"), c("closed_at"), _HOLIDAYS)
    return I.staged(spark, folder, "closed_date").select("unique_key", days.alias("business_days"))


_SLA_COLUMNS = ["closed_date", "agency", "complaint_type", "descriptor"]


@query("sla_compliant", over(ENRICHED, "SELECT unique_key, CAST(sla_days AS INTEGER) AS sla_days, sla_compliant FROM enr"))
def sla_compliant(spark, folder):
    return I.enriched(spark, folder, *_SLA_COLUMNS).select("unique_key", "sla_days", "sla_compliant")


@query("sla_compliant_strict", over(ENRICHED, "SELECT unique_key, CASE WHEN closed_at >= created_at THEN sla_compliant END AS sla_compliant FROM enr"))
def sla_compliant_strict(spark, folder):
    rows = I.enriched(spark, folder, *_SLA_COLUMNS)
    strict = D.sla_compliant(c("created_at"), c("closed_at"), c("sla_days"), strict=True)
    return rows.select("unique_key", strict.alias("sla_compliant"))


@query("open_age_days", over(ENRICHED, "SELECT unique_key, open_request_age_days FROM enr WHERE status = 'Open'"))
def open_age_days(spark, folder):
    return I.enriched(spark, folder, "status").where(c("status") == "Open").select("unique_key", "open_request_age_days")


@query("complaint_category", over(STAGED, f"""
SELECT complaint_type, {O.category("complaint_type")} AS category, count(*) AS requests FROM stg GROUP BY ALL"""))
def complaint_category(spark, folder):
    rows = I.staged(spark, folder, "complaint_type")
    return rows.groupBy("complaint_type", R.complaint_category(c("complaint_type")).alias("category")).agg(_n())


_KEYWORDS = O.category("text", V.KEYWORD_RULES, V.OTHER_KEYWORD)


@query("complaint_category_kw", f"""
WITH {RAW.strip()}, texts AS (
  SELECT complaint_type, incident_address, coalesce(complaint_type, '') || chr(1) || coalesce(incident_address, '') AS text FROM raw)
SELECT complaint_type, {_KEYWORDS} AS category, lower(coalesce(complaint_type, '')) AS subcategory, count(*) AS requests
FROM texts GROUP BY ALL""")
def complaint_category_kw(spark, folder):
    """The keyword rules over type and address text, which hits rules that brand names never would."""
    rows = I.raw(spark, folder, "complaint_type", "incident_address")
    label = R.keyword_category(c("complaint_type"), c("incident_address"))
    sub = F.lower(F.coalesce("complaint_type", F.lit("")))
    return rows.groupBy("complaint_type", label.alias("category"), sub.alias("subcategory")).agg(_n())


@query("date_keys", over(ENRICHED, """
SELECT created_date_key, closed_date_key, created_week_key, created_month_key, count(*) AS requests FROM enr GROUP BY ALL"""))
def date_keys(spark, folder):
    rows = I.enriched(spark, folder, "closed_date")
    return rows.groupBy("created_date_key", "closed_date_key", "created_week_key", "created_month_key").agg(_n())


@query("is_emergency", over(ENRICHED, "SELECT complaint_type, is_emergency, count(*) AS requests FROM enr GROUP BY ALL"))
def is_emergency(spark, folder):
    return I.enriched(spark, folder, "complaint_type").groupBy("complaint_type", "is_emergency").agg(_n())


@query("has_coordinates", over(ENRICHED, "SELECT latitude, longitude, has_coordinates, count(*) AS requests FROM enr GROUP BY ALL"))
def has_coordinates(spark, folder):
    rows = I.enriched(spark, folder, "latitude", "longitude")
    return rows.groupBy("latitude", "longitude", "has_coordinates").agg(_n())


def _part(number: int) -> str:
    return f"nullif(regexp_extract(upper(incident_address), '{V.ADDRESS_PATTERN}', {number}), '')"


@query("address_parts", over(RAW, f"""
SELECT incident_address, {_part(1)} AS house_number, {_part(2)} AS street_name, {_part(3)} AS street_type,
  CASE WHEN {_part(4)} IS NOT NULL THEN {_part(4)} || ' ' || {_part(5)} END AS unit, count(*) AS requests FROM raw GROUP BY ALL"""))
def address_parts(spark, folder):
    addresses = I.raw(spark, folder, "incident_address").groupBy("incident_address").agg(_n())
    parts = addresses.withColumn("p", S.address_parts(c("incident_address")))
    return parts.select("incident_address", "p.house_number", "p.street_name", "p.street_type", "p.unit", "requests")


_LOOKUP = O.policies(V.LOOKUP_POLICIES)


@query("transform_records", f"""
WITH {RAW.strip()},
std AS (
  SELECT *, {_AGENCY_SQL} AS std_agency, {O.parse_time("created_date")} AS created, {O.parse_time("closed_date")} AS closed FROM raw
),
joined AS (
  SELECT s.*, coalesce(p.sla_days, 30) AS sla_days,
    CASE WHEN closed >= created THEN {O.days("created", "closed")} END AS resolution_days
  FROM std s LEFT JOIN {_LOOKUP} ON p.agency = s.std_agency AND p.complaint_type = s.complaint_type
)
SELECT unique_key, {O.borough("borough")} AS borough, std_agency AS agency,
  CASE WHEN regexp_matches(incident_zip, '^[0-9]{{5}}') AND CAST(left(incident_zip, 5) AS INTEGER) BETWEEN {V.ZIP_LOW} AND {V.ZIP_HIGH}
    THEN left(incident_zip, 5) END AS incident_zip,
  created AS created_date_parsed, closed AS closed_date_parsed, resolution_days, CAST(sla_days AS INTEGER) AS sla_days,
  resolution_days <= sla_days AS sla_compliant,
  {O.category("(coalesce(complaint_type, '') || chr(1) || coalesce(descriptor, ''))", V.KEYWORD_RULES, V.OTHER_KEYWORD)} AS complaint_category,
  lower(coalesce(complaint_type, '')) AS complaint_subcategory,
  CASE WHEN json_valid(location) THEN json_extract_string(location, '$.type') END AS location_type_parsed,
  CASE WHEN json_valid(location) THEN TRY_CAST(json_extract_string(location, '$.coordinates[0]') AS DOUBLE) END AS lon,
  CASE WHEN json_valid(location) THEN TRY_CAST(json_extract_string(location, '$.coordinates[1]') AS DOUBLE) END AS lat,
  (latitude IS NOT NULL AND longitude IS NOT NULL) AS has_coordinates,
  CASE WHEN status = 'Open' THEN {O.days("created", f"TIMESTAMP '{AS_OF}'")} END AS open_request_age_days
FROM joined""")
def transform_records(spark, folder):
    done = transformed_records(I.raw(spark, folder), policy_frame(spark, V.LOOKUP_POLICIES), AS_OF)
    place = c("location_coordinates")
    return done.select("*", F.get(place, 0).alias("lon"), F.get(place, 1).alias("lat")).drop("location_coordinates")


@query("agency_domain", over(STAGED, f"SELECT agency_code, {O.agency_domain('agency_code')} AS agency_domain, count(*) AS requests FROM stg GROUP BY ALL"))
def agency_domain(spark, folder):
    rows = I.staged(spark, folder, "agency")
    return rows.groupBy("agency_code", S.agency_domain(c("agency_code")).alias("agency_domain")).agg(_n())


@query("borough_geo", over(STAGED + O.DIMS, """
SELECT s.borough, d.county_name, d.borough_sort_order, count(*) AS requests FROM stg s JOIN dim_borough d ON d.borough_key = s.borough GROUP BY ALL"""))
def borough_geo(spark, folder):
    name = c("borough")
    rows = I.staged(spark, folder, "borough")
    return rows.groupBy(
        "borough", S.county(name).alias("county_name"), S.borough_order(name).alias("borough_sort_order")
    ).agg(_n())


@query("surrogate_key", over(STAGED, f"""
SELECT complaint_type, descriptor, {O.surrogate("complaint_type", "descriptor")} AS complaint_type_key, count(*) AS requests FROM stg GROUP BY ALL"""))
def surrogate_key_query(spark, folder):
    pairs = I.staged(spark, folder, "complaint_type", "descriptor").groupBy("complaint_type", "descriptor").agg(_n())
    return pairs.withColumn("complaint_type_key", surrogate_key(c("complaint_type"), c("descriptor")))


@query("sla_default", over(ENRICHED, """
SELECT agency_code, complaint_type, CAST(sla_days AS INTEGER) AS sla_days, count(*) AS requests FROM enr GROUP BY ALL"""))
def sla_default(spark, folder):
    rows = I.enriched(spark, folder, "agency", "complaint_type")
    return rows.groupBy("agency_code", "complaint_type", "sla_days").agg(_n())


@query("dim_date", over(O.FIT, """
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
  (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25) AS is_federal_holiday
FROM (SELECT unnest(range(min(CAST(created_at AS DATE)), max(CAST(created_at AS DATE)) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM fit)"""))
def dim_date(spark, folder):
    """The calendar over the days found in the data."""
    return dim_date_spanning(I.with_time(I.fit(spark, folder)), "created_at")
