"""The same layers as common table expressions in portable SQL, written independently of the Spark plans."""

from __future__ import annotations

from requestlens import fixed_values as V
from requestlens.sources import star_requests as R


def _list(values) -> str:
    return "[" + R.text_list(values) + "]"


def _in(values) -> str:
    return "(" + R.text_list(values) + ")"


def _pick(values, index: str) -> str:
    return f"{_list(values)}[CAST(({index}) + 1 AS INTEGER)]"


def parse_time(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
        "(T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?| [0-9]{2}:[0-9]{2}:[0-9]{2})?') "
        f"THEN TRY_CAST(replace({column}, 'T', ' ') AS TIMESTAMP) END"
    )


def days(start: str, end: str) -> str:
    return f"(CAST(date_diff('microsecond', {start}, {end}) AS DOUBLE) / 86400e6)"


def rounded(value: str, places: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return rounded(f"100e0 * ({part}) / nullif({whole}, 0)")


def fraction(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif({whole}, 0)"


def category(column: str, rules=None, otherwise: str = V.OTHER_CATEGORY) -> str:
    branches = " ".join(
        f"WHEN {' OR '.join(f'''lower({column}) LIKE '%{word}%' ''' for word in words)} THEN '{label}'"
        for label, words in (rules or V.CATEGORY_RULES)
    )
    return f"CASE {branches} ELSE '{otherwise}' END"


def borough(column: str) -> str:
    branches = " ".join(
        f"WHEN upper(trim({column})) IN {_in(aliases)} THEN '{name}'" for name, aliases in V.BOROUGH_ALIASES.items()
    )
    return f"CASE {branches} ELSE '{V.UNSPECIFIED}' END"


def agency_domain(column: str) -> str:
    branches = " ".join(f"WHEN {column} IN {_in(members)} THEN '{domain}'" for domain, members in V.AGENCY_DOMAINS.items())
    return f"CASE {branches} ELSE '{V.OTHER_DOMAIN}' END"


def surrogate(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce({column}, '{V.SURROGATE_NULL}')" for column in columns)
    return f"md5({parts})"


def policies(rows=None) -> str:
    def value(item):
        return "NULL" if item is None else str(item).upper() if isinstance(item, bool) else str(item) if isinstance(item, int) else f"'{item}'"

    body = ", ".join(f"({n}, {', '.join(value(item) for item in row)})" for n, row in enumerate(rows or V.SLA_POLICIES, 1))
    return f"(VALUES {body}) AS p(policy_no, agency, complaint_type, descriptor, sla_days, business_hours_only)"


_AGENCY = _pick([a for a, _ in R.REQUEST_KINDS], "pk % 32")
_TITLE = _pick([R.AGENCY_TITLES[a] for a, _ in R.REQUEST_KINDS], "pk % 32")
_LAT = "('40.' || (40 + ck % 60))"
_LON = "(CASE WHEN ck % 2 = 0 THEN '-73.' ELSE '-74.' END || lpad(CAST(ck * 7 % 100 AS VARCHAR), 2, '0'))"

RAW = f"""
src AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_returnflag AS rf,
         o_orderstatus AS os, c_custkey AS ck, n_regionkey AS rk, p_name, p_brand, p_size,
         o_orderdate + INTERVAL {R.DAY_SHIFT} DAY - to_days(CASE WHEN l_partkey % 8 = 0 THEN 31 ELSE 0 END) + to_minutes((l_orderkey * 37 + l_linenumber * 101 + l_partkey) % 1440) AS created
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
),
stated AS (
  SELECT *, CASE os
    WHEN 'F' THEN CASE pk % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'In Progress' ELSE 'Closed' END
    WHEN 'O' THEN CASE WHEN pk % 5 = 0 THEN 'Closed' ELSE 'Open' END
    ELSE CASE WHEN pk % 6 = 0 THEN 'Closed' WHEN ln % 2 = 0 THEN 'In Progress' ELSE 'Pending' END END AS status
  FROM src
),
raw AS (
  SELECT
    CASE WHEN ok % 997 <> 0 THEN ok || '-' || ln END AS unique_key,
    CASE WHEN ok % 503 = 0 THEN 'invalid'
         WHEN ln % 4 = 0 THEN strftime(created, '%Y-%m-%dT%H:%M:%S') || '.000000'
         WHEN ln % 4 = 2 THEN strftime(created, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(created, '%Y-%m-%dT%H:%M:%S') END AS created_date,
    CASE WHEN status = 'Closed' AND ok % 13 <> 0
         THEN strftime(created + to_minutes((ok * 53 + pk * 7 + ln) % 86400 - 1440), '%Y-%m-%dT%H:%M:%S')
         WHEN ln % 2 = 0 THEN '' END AS closed_date,
    CASE ln % 4 WHEN 1 THEN ' ' || lower({_AGENCY}) || ' ' WHEN 2 THEN {_TITLE} ELSE {_AGENCY} END AS agency,
    CASE WHEN sk % 10 = 0 THEN {_TITLE} || ' Office' ELSE {_TITLE} END AS agency_name,
    {_pick([k for _, k in R.REQUEST_KINDS], "pk % 32")} AS complaint_type,
    CASE WHEN p_size % 10 <> 0 THEN p_brand END AS descriptor,
    {_pick(R.PLACE_TYPES, "ln % 6")} AS location_type,
    CASE WHEN ok % 31 = 0 THEN NULL WHEN ok % 29 = 0 THEN 'abcde'
         ELSE (10001 + ck % 1800) || CASE WHEN ln = 5 THEN '-1234' ELSE '' END END AS incident_zip,
    CASE WHEN ok % 41 <> 0 THEN (ok % 900 + 1) || ' ' || upper(p_name) || ' ' || {_pick(R.STREET_SUFFIXES, "pk % 12")}
         || CASE WHEN ln % 3 = 0 THEN ' APT ' || ln || 'B' ELSE '' END END AS incident_address,
    CASE WHEN ok % 23 = 0 THEN CASE ln % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'UNKNOWN' END
         ELSE {_pick(R.BOROUGH_SPELLINGS, "rk * 3 + ln % 3")} END AS borough,
    CASE WHEN ok % 11 <> 0 THEN {_LAT} END AS latitude,
    CASE WHEN ok % 11 <> 0 THEN {_LON} END AS longitude,
    CASE WHEN ok % 11 = 0 THEN NULL WHEN ok % 37 = 0 THEN '{{"type": "Point", '
         ELSE '{{"type": "Point", "coordinates": [' || {_LON} || ', ' || {_LAT} || ']}}' END AS location,
    status,
    CASE WHEN ok % 7 <> 0 THEN rf END AS resolution_description,
    TIMESTAMP '{R.BASE_INGEST}' + to_hours((ok + pk) % 5) + to_seconds((ok * 13 + sk * 7) % 3000) AS ingested_at,
    'batch_' || ((ok + pk) % 5) AS batch_id,
    pk || '-' || sk || '-' || rf AS source_row
  FROM stated
)"""

FIT = RAW + f""",
fit AS (
  SELECT *, {parse_time("created_date")} AS created_at FROM raw
  WHERE unique_key IS NOT NULL AND ({parse_time("created_date")}) IS NOT NULL
)"""

CURRENT = FIT + """,
cur AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY ingested_at DESC, source_row DESC) AS rn FROM fit
  ) WHERE rn = 1
)"""

STAGED = CURRENT + f""",
stg AS (
  SELECT unique_key, created_at,
    {parse_time("nullif(trim(closed_date), '')")} AS closed_at,
    upper(trim(agency)) AS agency_code, trim(agency_name) AS agency_name, trim(complaint_type) AS complaint_type,
    trim(descriptor) AS descriptor, upper(trim(location_type)) AS location_type,
    regexp_replace(incident_zip, '[^0-9]', '', 'g') AS incident_zip, trim(incident_address) AS incident_address,
    {borough("borough")} AS borough, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    trim(status) AS status, trim(resolution_description) AS resolution_description, ingested_at, batch_id
  FROM cur
)"""

ENRICHED = STAGED + f""",
pol AS (SELECT * FROM {policies()}),
priced AS (
  SELECT s.*, coalesce((
      SELECT p.sla_days FROM pol p
      WHERE p.agency = s.agency_code AND (p.complaint_type = s.complaint_type OR p.complaint_type = '*')
        AND (p.descriptor IS NULL OR p.descriptor = s.descriptor OR p.descriptor = '*')
      ORDER BY CASE WHEN p.complaint_type = '*' THEN 1 ELSE 0 END,
               CASE WHEN p.descriptor IS NULL OR p.descriptor = '*' THEN 1 ELSE 0 END, p.policy_no
      LIMIT 1), {V.DEFAULT_SLA_DAYS}) AS sla_days
  FROM stg s
),
enr AS (
  SELECT *,
    CASE WHEN closed_at IS NOT NULL THEN {days("created_at", "closed_at")} END AS resolution_days,
    CASE WHEN closed_at IS NOT NULL THEN {days("created_at", "closed_at")} <= sla_days END AS sla_compliant,
    CASE WHEN status = 'Open' THEN {days("created_at", f"TIMESTAMP '{R.AS_OF}'")} END AS open_request_age_days,
    {category("complaint_type")} AS complaint_category,
    CAST(created_at AS DATE) AS created_date_key, CAST(closed_at AS DATE) AS closed_date_key,
    CAST(date_trunc('week', created_at) AS DATE) AS created_week_key,
    CAST(date_trunc('month', created_at) AS DATE) AS created_month_key,
    coalesce(lower(complaint_type) LIKE '%heat%' OR lower(complaint_type) LIKE '%hot water%', false) AS is_emergency,
    (latitude IS NOT NULL AND longitude IS NOT NULL) AS has_coordinates
  FROM priced
)"""

DIMS = f""",
dim_agency AS (
  SELECT agency_code AS agency_key, agency_name, {agency_domain("agency_code")} AS agency_domain FROM (
    SELECT agency_code, agency_name, row_number() OVER (
      PARTITION BY agency_code ORDER BY (agency_name IS NULL), count(*) DESC, agency_name) AS rn
    FROM stg WHERE agency_code IS NOT NULL GROUP BY agency_code, agency_name
  ) WHERE rn = 1
),
dim_borough AS (
  SELECT DISTINCT borough AS borough_key, borough AS borough_name,
    CASE borough WHEN 'MANHATTAN' THEN 'New York County' WHEN 'BRONX' THEN 'Bronx County' WHEN 'BROOKLYN' THEN 'Kings County'
      WHEN 'QUEENS' THEN 'Queens County' WHEN 'STATEN ISLAND' THEN 'Richmond County' ELSE 'Unspecified' END AS county_name,
    CASE borough WHEN 'MANHATTAN' THEN 1 WHEN 'BRONX' THEN 2 WHEN 'BROOKLYN' THEN 3 WHEN 'QUEENS' THEN 4
      WHEN 'STATEN ISLAND' THEN 5 ELSE 0 END AS borough_sort_order
  FROM stg WHERE borough IS NOT NULL
),
dim_complaint AS (
  SELECT DISTINCT {surrogate("complaint_type", "descriptor")} AS complaint_type_key, complaint_type, descriptor,
    {category("complaint_type")} AS complaint_category
  FROM stg WHERE complaint_type IS NOT NULL
)"""

_FACT = """,
fact AS (
  SELECT e.unique_key AS request_key, e.created_date_key, e.closed_date_key, a.agency_key, c.complaint_type_key, b.borough_key,
    e.agency_code, e.agency_name, e.complaint_type, e.descriptor, e.complaint_category, e.borough, e.incident_zip, e.status,
    e.location_type, e.resolution_days, e.sla_days, e.sla_compliant, e.open_request_age_days, e.is_emergency,
    e.has_coordinates, e.latitude, e.longitude, e.created_at, e.closed_at
  FROM enr e LEFT JOIN dim_agency a ON a.agency_key = e.agency_code
  LEFT JOIN dim_complaint c ON c.complaint_type = e.complaint_type AND c.descriptor IS NOT DISTINCT FROM e.descriptor
  LEFT JOIN dim_borough b ON b.borough_key = e.borough
)"""
FACT = ENRICHED + DIMS + _FACT
# The same fact on dimensions that know the first batch only.
CHECKED_FACT = ENRICHED + """,
known AS (SELECT * FROM stg WHERE batch_id = 'batch_0')""" + DIMS.replace("FROM stg", "FROM known") + _FACT

CALENDAR = f""",
dim_date AS (
  SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month
  FROM range(DATE '{V.CALENDAR_START}', DATE '{V.CALENDAR_END_EXCLUSIVE}', INTERVAL 1 DAY) AS r(d)
)"""


def over(layer: str, body: str) -> str:
    return f"WITH {layer.strip()}\n{body}"
