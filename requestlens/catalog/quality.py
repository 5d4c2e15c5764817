"""Expectations, column tests, fact invariants and the run summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog import oracle as O
from requestlens.catalog.oracle import CHECKED_FACT, CALENDAR, FACT, RAW, over
from requestlens.catalog.registry import query
from requestlens.operators.cursor import created_at
from requestlens.operators.dead_letters import ingest_stats
from requestlens.plans import checks as K
from requestlens.plans import dimensions as D
from requestlens.plans import marts as M
from requestlens.plans import suite as Q
from requestlens.plans.fact import build_fact
from requestlens.plans.run_summary import summarize
from requestlens.plans.suite_store import SuiteCounts
from requestlens.session import fresh_path, store

c = F.col
_SUITE = Q.request_suite()
_SUITE_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type", "descriptor", "location_type",
    "incident_zip", "borough", "latitude", "longitude", "status", "resolution_description",
]


def _is_in(column, values):
    return f"({column} IS NOT NULL AND {column} NOT IN {O._in(values)})"


def _out(column, bounds):
    return (
        f"({column} IS NOT NULL AND (TRY_CAST({column} AS DOUBLE) IS NULL OR TRY_CAST({column} AS DOUBLE) "
        f"NOT BETWEEN {bounds[0]} AND {bounds[1]}))"
    )


_FORMAT = "(created_date IS NOT NULL AND NOT regexp_full_match(created_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{1,6}'))"
_PAIR = f"(({O.parse_time('closed_date')}) < ({O.parse_time('created_date')}))"
_ZIP = "(incident_zip IS NOT NULL AND NOT regexp_full_match(incident_zip, '[0-9]{5}'))"

# Number, type, column, dimension, severity, condition of an unexpected row, required share.
_RULES = [
    (1, Q.NOT_NULL, "unique_key", "completeness", "critical", "unique_key IS NULL", 1.0),
    (2, Q.UNIQUE, "unique_key", "uniqueness", "critical", "copies > 1", 1.0),
    (3, Q.NOT_NULL, "created_date", "completeness", "critical", "created_date IS NULL", 1.0),
    (4, Q.TEXT_FORMAT, "created_date", "format", "warning", _FORMAT, 1.0),
    (5, Q.BETWEEN, "closed_date", "referential_integrity", "warning", _PAIR, 1.0),
    (6, Q.NOT_NULL, "agency", "completeness", "critical", "agency IS NULL", 1.0),
    (7, Q.IN_SET, "agency", "referential_integrity", "warning", _is_in("agency", V.AGENCY_CODES), 1.0),
    (8, Q.NOT_NULL, "agency_name", "completeness", "warning", "agency_name IS NULL", 1.0),
    (9, Q.NOT_NULL, "complaint_type", "completeness", "critical", "complaint_type IS NULL", 1.0),
    (10, Q.NOT_NULL, "descriptor", "completeness", "warning", "descriptor IS NULL", 0.9),
    (11, Q.IN_SET, "location_type", "validity", "warning", _is_in("location_type", V.LOCATION_TYPES), 1.0),
    (12, Q.REGEX, "incident_zip", "validity", "warning", _ZIP, 0.85),
    (13, Q.NOT_NULL, "borough", "completeness", "critical", "borough IS NULL", 1.0),
    (14, Q.IN_SET, "borough", "referential_integrity", "critical", _is_in("borough", V.BOROUGHS), 1.0),
    (15, Q.BETWEEN, "latitude", "validity", "warning", _out("latitude", V.LATITUDE_BOUNDS), 0.7),
    (16, Q.BETWEEN, "longitude", "validity", "warning", _out("longitude", V.LONGITUDE_BOUNDS), 0.7),
    (17, Q.IN_SET, "status", "validity", "warning", _is_in("status", V.STATUSES), 1.0),
    (18, Q.NOT_NULL, "resolution_description", "completeness", "info", "resolution_description IS NULL", 0.8),
]


def _results_sql(source: str, group: str | None = None) -> str:
    """One SELECT per rule over ``source``, which carries the number of copies of each key."""
    key = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    selects = []
    for number, kind, column, dimension, severity, wrong, mostly in _RULES:
        missing = f"count(*) FILTER (WHERE {column} IS NULL)"
        population = "count(*)" if kind == Q.NOT_NULL else f"count({column})"
        bad = f"count(*) FILTER (WHERE {wrong})"
        selects.append(
            f"SELECT {key}{number} AS expectation_no, '{kind}' AS expectation_type, '{column}' AS column_name, "
            f"'{dimension}' AS dimension, '{severity}' AS severity, count(*) AS element_count, {missing} AS missing_count, "
            f"{bad} AS unexpected_count, round(100e0 * {bad} / nullif({population}, 0), 6) AS unexpected_percent, "
            f"CAST(NULL AS BIGINT) AS observed_value, "
            f"{population} = 0 OR ({population} - {bad}) / CAST(nullif({population}, 0) AS DOUBLE) >= {mostly} AS success "
            f"FROM {source}{tail}"
        )
    low, high = V.ROW_COUNT_BOUNDS
    selects.append(
        f"SELECT {key}19, '{Q.ROW_COUNT}', NULL, 'volume', 'warning', count(*), 0, 0, NULL, count(*), "
        f"count(*) BETWEEN {low} AND {high} FROM {source}{tail}"
    )
    return "\nUNION ALL ".join(selects)


_COPIES = RAW + """,
counted AS (SELECT *, CASE WHEN unique_key IS NOT NULL THEN count(*) OVER (PARTITION BY unique_key) END AS copies FROM raw)"""
_RESULTS = _COPIES + f""",
results AS ({_results_sql("counted")})"""


def _suite_input(spark, folder):
    return I.raw(spark, folder, *_SUITE_COLUMNS)


def _results(spark, folder):
    """The raw rows are derived once: row-level and uniqueness expectations both read the stored keys and flags."""
    return Q.evaluate_flagged(store(Q.flagged(_suite_input(spark, folder), _SUITE), "suite-flags"), _SUITE)


def _subset(*numbers):
    rules = [rule for number, rule in enumerate(_SUITE["expectations"], 1) if number in numbers]
    return {"expectations": rules}


_OUT = "expectation_type, column_name, element_count, missing_count, unexpected_count, unexpected_percent, success"


def _register_kind(name, numbers):
    wanted = ", ".join(str(number) for number in numbers)

    @query(name, over(_RESULTS, f"SELECT {_OUT} FROM results WHERE expectation_no IN ({wanted})"))
    def run(spark, folder):
        suite = _subset(*numbers)
        columns = list(dict.fromkeys(rule["kwargs"].get("column", "unique_key") for rule in suite["expectations"]))
        extra = ["created_date"] if 5 in numbers else []
        results = Q.evaluate(I.raw(spark, folder, *columns, *extra), suite)
        return results.select(*[part.strip() for part in _OUT.split(",")])


for _name, _numbers in {
    "x_not_null": [1, 3, 6, 8, 9, 10, 13, 18],
    "x_unique": [2],
    "x_in_set": [7, 11, 14, 17],
    "x_regex": [12],
    "x_between": [15, 16],
    "x_pair_order": [5],
    "x_ts_format": [4],
    "x_row_count": [19],
}.items():
    _register_kind(_name, _numbers)


@query("x_suite_results", over(_RESULTS, "SELECT * FROM results"))
def x_suite_results(spark, folder):
    return _results(spark, folder)


@query("x_suite_merged", over(_RESULTS, "SELECT * FROM results"))
def x_suite_merged(spark, folder):
    """The suite over all rows, from counts that were stored batch by batch."""
    rows = store(I.raw(spark, folder, *_SUITE_COLUMNS, "batch_id"), "suite-input")
    counts = SuiteCounts(spark, fresh_path(spark, "suite-counts"), _SUITE)
    for batch in range(5):
        counts.add(rows.where(F.col("batch_id") == f"batch_{batch}"), f"batch_{batch}")
    return counts.results()


_STATS = """count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
  count(*) FILTER (WHERE NOT success) AS failed_expectations, bool_and(success) AS success"""


@query("x_suite_stats", over(_RESULTS, f"SELECT {_STATS} FROM results"))
def x_suite_stats(spark, folder):
    return Q.statistics(_results(spark, folder))


@query("x_by_dimension", over(_RESULTS, f"SELECT dimension, severity, {_STATS} FROM results GROUP BY ALL"))
def x_by_dimension(spark, folder):
    return Q.by_dimension(_results(spark, folder))


@query("x_gate", over(_RESULTS, """
SELECT bool_and(success) FILTER (WHERE severity = 'critical') AS passed,
  count(*) FILTER (WHERE severity = 'critical' AND NOT success) AS blocking_failures,
  count(*) FILTER (WHERE severity <> 'critical' AND NOT success) AS other_failures FROM results"""))
def x_gate(spark, folder):
    return Q.gate(_results(spark, folder))


@query("x_checkpoint_latest", over(RAW + """,
newest AS (SELECT * FROM raw WHERE batch_id = (SELECT max(batch_id) FROM raw)),
counted AS (SELECT *, CASE WHEN unique_key IS NOT NULL THEN count(*) OVER (PARTITION BY unique_key) END AS copies FROM newest)""",
    f"SELECT *, 'run-1' AS run_id FROM ({_results_sql('counted', 'batch_id')})"))
def x_checkpoint_latest(spark, folder):
    rows = store(I.raw(spark, folder, *_SUITE_COLUMNS, "batch_id"), "suite-input")
    return Q.checkpoint_run(rows, _SUITE, "run-1")


@query("x_suite_by_day", over(RAW + f""",
dated AS (SELECT *, CAST({O.parse_time("created_date")} AS DATE) AS created_day FROM raw),
counted AS (SELECT *, CASE WHEN unique_key IS NOT NULL THEN count(*) OVER (PARTITION BY unique_key, created_day) END AS copies FROM dated)""",
    _results_sql("counted", "created_day")))
def x_suite_by_day(spark, folder):
    rows = _suite_input(spark, folder).withColumn("created_day", F.to_date(created_at()))
    flags = store(Q.flagged(rows, _SUITE, ["created_day"]), "suite-flags")
    return Q.evaluate_flagged(flags, _SUITE, ["created_day"])


@query("x_key_format", over(RAW, """
SELECT count(*) AS element_count, count(*) FILTER (WHERE unique_key IS NULL) AS missing_count,
  count(*) FILTER (WHERE NOT regexp_full_match(unique_key, '[0-9]{10}')) AS unexpected_count FROM raw"""))
def x_key_format(spark, folder):
    rule = Q.expectation(Q.REGEX, "validity", "warning", column="unique_key", regex=V.KEY_PATTERN)
    results = Q.evaluate(I.raw(spark, folder, "unique_key"), {"expectations": [rule]})
    return results.select("element_count", "missing_count", "unexpected_count")


def _test_tables(spark, folder):
    """Every model the column tests name. The enriched columns are stored once; the rest derives from them."""
    raw = I.raw(spark, folder, "unique_key", "created_date", "agency", "borough")
    used = [
        "unique_key", "created_at", "created_date_key", "closed_date_key", "agency_code", "agency_name", "complaint_type",
        "descriptor", "complaint_category", "borough", "incident_zip", "status", "location_type", "resolution_days",
        "sla_days", "sla_compliant", "open_request_age_days", "is_emergency", "has_coordinates", "latitude", "longitude",
        "closed_at", "dbt_updated_at",
    ]
    enriched = store(I.enriched(spark, folder, *I.FACT_INPUT).select(*used), "enriched")
    dims = I.stored_dims(enriched)
    fact = store(build_fact(enriched, dims), "fact")
    return {
        "raw_requests": raw,
        "stg_requests": enriched,
        "int_requests_enriched": enriched,
        "int_daily_agency_metrics": M.daily_agency_metrics(enriched, median=False),
        "fact_service_requests": fact,
        "agg_monthly_borough_performance": M.monthly_borough_performance(fact, D.dim_date(spark), dims["borough"], median=False),
        "agg_agency_sla_scorecard": M.agency_sla_scorecard(fact, dims["agency"], median=False),
        "dim_date": D.dim_date(spark),
        "dim_agency": dims["agency"],
        "dim_borough": dims["borough"],
        "dim_complaint_type": dims["complaint_type"],
    }


_SOURCES = {
    "raw_requests": "raw", "stg_requests": "stg", "int_requests_enriched": "enr", "fact_service_requests": "fact",
    "int_daily_agency_metrics": "daily", "agg_monthly_borough_performance": "monthly", "agg_agency_sla_scorecard": "card",
    "dim_date": "dim_date", "dim_agency": "dim_agency", "dim_borough": "dim_borough", "dim_complaint_type": "dim_complaint",
}


def _test_sql(test):
    source, column, args = _SOURCES[test["model"]], test["column"], test["args"]
    failing = {
        "not_null": lambda: f"count(*) FILTER (WHERE {column} IS NULL) FROM {source}",
        "accepted_values": lambda: f"count(*) FILTER (WHERE {column} NOT IN {O._in(args['values'])}) FROM {source}",
        "matches": lambda: f"count(*) FILTER (WHERE NOT regexp_full_match({column}, '[0-9]{{5}}')) FROM {source}",
        "between": lambda: f"count(*) FILTER (WHERE {column} NOT BETWEEN {args['min_value']} AND {args['max_value']}) FROM {source}",
        "unique": lambda: f"count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
        "relationships": lambda: (
            f"count(*) FROM {source} x WHERE x.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_SOURCES[args['to']]} d WHERE d.{args['field']} = x.{column})"
        ),
    }[test["test"]]()
    return (
        f"SELECT '{test['model']}' AS model, '{column}' AS column_name, '{test['test']}' AS test, "
        f"'{test['severity']}' AS severity, {failing.replace(' FROM ', ' AS failures FROM ', 1)}"
    )


_RATE = O.percent("count(*) FILTER (WHERE sla_compliant)", "count(sla_compliant)")
_TESTS = "\nUNION ALL ".join(_test_sql(test) for test in K.request_model_tests())


@query("t_column_tests", over(FACT + CALENDAR + f""",
daily AS (SELECT created_date_key AS date_key, {_RATE} AS sla_compliance_rate FROM enr
  GROUP BY created_date_key, agency_code, agency_name, borough, complaint_category),
monthly AS (SELECT {_RATE} AS sla_compliance_rate_pct FROM fact GROUP BY date_trunc('month', created_date_key), borough_key),
card AS (SELECT {_RATE} AS sla_compliance_rate_pct FROM fact
  WHERE created_at >= (SELECT max(created_at) - INTERVAL 90 DAY FROM fact) GROUP BY agency_key, agency_name)""",
    f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({_TESTS})"""))
def t_column_tests(spark, folder):
    return K.run_column_tests(_test_tables(spark, folder), K.request_model_tests())


_LAT, _LON = V.LATITUDE_BOUNDS, V.LONGITUDE_BOUNDS
_CHECKS = {
    "missing_agency": "agency_key IS NULL",
    "missing_borough": "borough_key IS NULL",
    "missing_complaint_type": "complaint_type_key IS NULL",
    "missing_date": "created_date_key IS NULL",
    "negative_resolution": "resolution_days < 0",
    "compliance_on_open_request": "sla_compliant IS NOT NULL AND status <> 'Closed'",
    "emergency_without_one_day_sla": "is_emergency AND sla_days <> 1",
    "invalid_borough": f"borough NOT IN {O._in(V.BOROUGHS)}",
    "invalid_status": f"status NOT IN {O._in(V.STATUSES)}",
    "coordinates_out_of_bounds": (
        f"has_coordinates AND (latitude < {_LAT[0]} OR latitude > {_LAT[1]} OR longitude < {_LON[0]} OR longitude > {_LON[1]})"
    ),
}
_CHECK_COLUMNS = [
    "request_key", "created_date_key", "agency_key", "borough_key", "complaint_type_key", "resolution_days", "sla_compliant",
    "sla_days", "is_emergency", "has_coordinates", "status", "borough", "latitude", "longitude",
]


@query("q_missing_keys", over(CHECKED_FACT, "\nUNION ALL ".join(
    f"SELECT '{name}' AS test, count(*) AS failures FROM fact WHERE {rule}" for name, rule in _CHECKS.items() if name.startswith("missing"))))
def q_missing_keys(spark, folder):
    return K.missing_keys(I.checked_fact(spark, folder, *_CHECK_COLUMNS))


_FACT_CHECKS = "SELECT 'duplicate_keys' AS check_name, count(*) AS failures FROM (SELECT 1 FROM fact GROUP BY request_key HAVING count(*) > 1)\nUNION ALL " + "\nUNION ALL ".join(
    f"SELECT '{name}', count(*) FROM fact WHERE {rule}" for name, rule in _CHECKS.items())


@query("t_fact_checks", over(CHECKED_FACT, f"SELECT *, failures = 0 AS passed FROM ({_FACT_CHECKS})"))
def t_fact_checks(spark, folder):
    return K.fact_checks(I.checked_fact(spark, folder, *_CHECK_COLUMNS))


@query("t_violations", over(CHECKED_FACT, "\nUNION ALL ".join(
    f"SELECT request_key, '{name}' AS check_name FROM fact WHERE {rule}" for name, rule in _CHECKS.items())))
def t_violations(spark, folder):
    return K.violations(I.checked_fact(spark, folder, *_CHECK_COLUMNS))


@query("run_summary", f"""
WITH {CHECKED_FACT.strip()},
counted AS (SELECT *, CASE WHEN unique_key IS NOT NULL THEN count(*) OVER (PARTITION BY unique_key) END AS copies FROM raw),
results AS ({_results_sql("counted")})
SELECT (SELECT count(*) FROM raw) AS records_fetched, (SELECT count(*) FROM fit) AS records_upserted,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM fit) AS records_failed, (SELECT count(DISTINCT batch_id) FROM raw) AS batches,
  (SELECT count(*) FROM raw) = (SELECT count(*) FROM fit) AS ingestion_success,
  (SELECT bool_and(success) FROM results) AS validation_success,
  (SELECT bool_and(success) FROM results WHERE severity = 'critical') AS critical_passed,
  true AS models_success, (SELECT bool_and(failures = 0) FROM ({_FACT_CHECKS})) AS tests_success,
  (SELECT count(*) FROM raw) = (SELECT count(*) FROM fit) AS overall_success""")
def run_summary(spark, folder):
    raw = I.raw(spark, folder, *_SUITE_COLUMNS, "batch_id", "ingested_at")
    results = store(Q.evaluate(raw, _SUITE), "suite-results")
    checks = K.fact_checks(I.checked_fact(spark, folder, *_CHECK_COLUMNS))
    return summarize(ingest_stats(raw), results, checks)
