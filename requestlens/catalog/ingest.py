"""Sources, cursors, upserts and dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.catalog import inputs as I
from requestlens.catalog.oracle import CURRENT, FACT, FIT, RAW, STAGED, over, policies
from requestlens.catalog.registry import ORACLES, query
from requestlens.operators import cursor as C
from requestlens.operators import dead_letters as L
from requestlens.operators import upsert as U
from requestlens.operators.pages import OrderedTable
from requestlens.plans import fact as T
from requestlens.schemas import API_FIELDS
from requestlens.session import fresh_path, store
from requestlens.sources import landing
from requestlens.sources.seeds import policy_frame, read_policies
from requestlens.sources.star_requests import AS_OF, RULES, derived, request_lines

_VERSIONS = ["status", "resolution_description"]
_SINCE = "2024-06-01 00:00:00"
_ORDER = ["created_at", "unique_key"]


_PAGE_ROWS = 2000
_FILLED = [name for name in API_FIELDS if name in RULES]


@query("src_json_pages", over(RAW, f"""
SELECT batch_id, count(*) AS records, count(unique_key) AS keys, count(closed_date) AS closed_texts, count(location) AS locations,
  count(DISTINCT agency) AS agencies, CAST(sum(length(created_date)) AS BIGINT) AS created_length, CAST(sum(length(source_row)) AS BIGINT) AS row_length,
  {" + ".join(f"count({name})" for name in _FILLED)} AS filled, {len(API_FIELDS) - len(_FILLED)} AS empty_fields, 1 AS corrupt_pages
FROM raw GROUP BY 1"""))
def src_json_pages(spark, folder):
    """Land all raw rows with all fields as array pages, and a page that is cut off in every batch; read them back as text.

    Lines are dealt to pages before the raw columns, which are several times as wide, are derived from them.
    """
    path = fresh_path(spark, "pages")
    lines = store(request_lines(spark, folder, list(RULES)).select("*", *derived(["batch_id"])), "page-lines", "zstd")
    dealt = landing.deal_pages(lines, _PAGE_ROWS, lines.columns)
    rows = landing.conform(dealt.select("batch_id", "page", *derived([name for name in RULES if name != "batch_id"])))
    columns = [*API_FIELDS, "source_row"]
    landing.land_arrays(rows, path, columns, _PAGE_ROWS, "gzip", dealt=True)
    cut = lines.select("batch_id").distinct().select("batch_id", F.lit(-1).alias("page"), F.lit('[{"unique_key": "cut off", "status": "Op').alias("value"))
    cut.write.mode("append").partitionBy("batch_id", "page").text(path)
    pages = landing.read_pages(spark, path, array_pages=True, extra=("source_row",))
    whole = F.col(landing.CORRUPT).isNull()

    def filled(name):
        return F.count(F.when(whole, F.col(name)))

    counts = {name: filled(name) for name in API_FIELDS}
    return pages.groupBy("batch_id").agg(
        F.count_if(whole).alias("records"), counts["unique_key"].alias("keys"), counts["closed_date"].alias("closed_texts"),
        counts["location"].alias("locations"), F.count_distinct(F.when(whole, F.col("agency"))).alias("agencies"),
        F.sum(F.when(whole, F.length("created_date"))).alias("created_length"), F.sum(F.when(whole, F.length("source_row"))).alias("row_length"),
        sum(counts.values(), F.lit(0).cast("bigint")).alias("filled"),
        sum(((count == 0).cast("int") for count in counts.values()), F.lit(0)).alias("empty_fields"), F.count_if(~whole).alias("corrupt_pages"),
    )


@query("src_projection", over(RAW, """
SELECT unique_key, created_date, closed_date, agency, agency_name, complaint_type, descriptor, location_type, incident_zip,
  incident_address, CAST(NULL AS VARCHAR) AS street_name, CAST(NULL AS VARCHAR) AS cross_street_1,
  CAST(NULL AS VARCHAR) AS cross_street_2, CAST(NULL AS VARCHAR) AS city, borough, latitude, longitude, location, status,
  resolution_description, CAST(NULL AS VARCHAR) AS resolution_action_updated_date, CAST(NULL AS VARCHAR) AS community_board,
  CAST(NULL AS VARCHAR) AS council_district, CAST(NULL AS VARCHAR) AS census_tract, CAST(NULL AS VARCHAR) AS bin,
  CAST(NULL AS VARCHAR) AS bbl, CAST(NULL AS VARCHAR) AS nta
FROM raw"""))
def src_projection(spark, folder):
    return landing.api_projection(landing.conform(I.raw(spark, folder)))


@query("inc_since_filter", over(FIT, f"""
SELECT unique_key, created_at, status FROM fit WHERE created_at >= TIMESTAMP '{_SINCE}'"""))
def inc_since_filter(spark, folder):
    rows = I.with_time(I.fit(spark, folder, "status"))
    return C.since_filter(rows, _SINCE).select("unique_key", "created_at", "status")


_ordered_tables: dict[tuple[str, str], OrderedTable] = {}


def _ordered(spark, folder):
    """The current requests by creation and key, stored once in an application for each folder and shared by the pages of it."""
    name = (spark.sparkContext.applicationId, folder)
    if name not in _ordered_tables:
        rows = I.with_time(I.current(spark, folder, "status")).select("unique_key", "created_at", "status")
        _ordered_tables[name] = OrderedTable.write(rows, fresh_path(spark, "ordered"), _ORDER)
    return _ordered_tables[name]


@query("inc_page", over(CURRENT, """
SELECT unique_key, created_at, status FROM cur ORDER BY created_at, unique_key LIMIT 500 OFFSET 1000"""))
def inc_page(spark, folder):
    return _ordered(spark, folder).page(1000, 500)


@query("inc_page_deep", over(CURRENT, """
SELECT unique_key, created_at, status FROM cur ORDER BY created_at, unique_key LIMIT 700 OFFSET 3500"""))
def inc_page_deep(spark, folder):
    return _ordered(spark, folder).page(3500, 700)


@query("inc_page_after", over(CURRENT, """
SELECT unique_key, created_at, status FROM cur WHERE (created_at, unique_key) > (TIMESTAMP '2023-05-17 08:00:00', '5')
ORDER BY created_at, unique_key LIMIT 650"""))
def inc_page_after(spark, folder):
    key = [F.lit("2023-05-17 08:00:00").cast("timestamp_ntz"), F.lit("5")]
    return _ordered(spark, folder).page_after(key, 650)


@query("inc_page_counts", over(CURRENT, """
SELECT (rn - 1) // 5000 AS page, count(*) AS rows, min(created_at) AS first_created, max(created_at) AS last_created
FROM (SELECT created_at, row_number() OVER (ORDER BY created_at, unique_key) AS rn FROM cur) GROUP BY 1"""))
def inc_page_counts(spark, folder):
    return _ordered(spark, folder).page_counts(5000)


@query("inc_high_water_mark", over(FIT, "SELECT max(created_at) AS high_water_mark FROM fit"))
def inc_high_water_mark(spark, folder):
    return C.high_water_mark(I.with_time(I.fit(spark, folder)))


@query("inc_lookback", over(FIT, """
SELECT unique_key, created_at, batch_id FROM fit
WHERE created_at >= (SELECT max(created_at) - INTERVAL 7 DAY FROM fit WHERE batch_id < 'batch_4')"""))
def inc_lookback(spark, folder):
    """Rows of the source that fall into the lookback window of the batches stored so far."""
    rows = I.with_time(I.fit(spark, folder, "batch_id")).select("unique_key", "created_at", "batch_id")
    return C.lookback_window(rows, rows.where(F.col("batch_id") < "batch_4"), AS_OF)


@query("full_load_since", over(FIT, f"""
SELECT unique_key, created_at FROM fit WHERE created_at >= TIMESTAMP '{V.FULL_LOAD_START} 00:00:00'"""))
def full_load_since(spark, folder):
    return C.full_load(I.with_time(I.fit(spark, folder))).select("unique_key", "created_at")


@query("upsert_latest_wins", over(CURRENT, """
SELECT unique_key, created_date, status, resolution_description, ingested_at, batch_id, source_row FROM cur"""))
def upsert_latest_wins(spark, folder):
    """Batches 0 to 3 as the stored table, batch 4 as the incoming one."""
    rows = I.fit(spark, folder, *_VERSIONS, "batch_id")
    target, batch = rows.where(F.col("batch_id") < "batch_4"), rows.where(F.col("batch_id") == "batch_4")
    return U.upsert(target, batch, ties=I.TIES)


@query("upsert_idempotent", over(CURRENT, """
SELECT unique_key, created_date, status, resolution_description, ingested_at, batch_id, source_row FROM cur"""))
def upsert_idempotent(spark, folder):
    """The same batch applied twice to a stored month-partitioned table."""
    rows = I.fit(spark, folder, *_VERSIONS, "batch_id")
    path = fresh_path(spark, "requests")
    late = store(rows.where(F.col("batch_id") >= "batch_3"), "late-batches")
    U.upsert_table(rows.where(F.col("batch_id") < "batch_3"), path, ties=I.TIES)
    U.upsert_table(late, path, ties=I.TIES)
    U.upsert_table(late, path, ties=I.TIES)
    return spark.read.parquet(path).drop(U.MONTH, U.INSTANT)


@query("upsert_counts", over(FIT, """
SELECT count(*) AS records, count(DISTINCT CASE WHEN known IS NULL THEN f.unique_key END) AS inserted,
  count(DISTINCT CASE WHEN known IS NOT NULL THEN f.unique_key END) AS updated
FROM (SELECT unique_key FROM fit WHERE created_at >= TIMESTAMP '2026-01-01 00:00:00') f
LEFT JOIN (SELECT DISTINCT unique_key AS known FROM fit WHERE resolution_description = 'R') t ON t.known = f.unique_key"""))
def upsert_counts(spark, folder):
    rows = I.with_time(I.fit(spark, folder, "resolution_description"))
    batch = C.since_filter(rows, "2026-01-01 00:00:00")
    return U.upsert_counts(rows.where(F.col("resolution_description") == "R"), batch)


@query("batch_stamp", over(RAW, f"""
SELECT 'batch_20270803_120000' AS batch_id, TIMESTAMP '{AS_OF}' AS ingested_at, status, count(*) AS records FROM raw GROUP BY status"""))
def batch_stamp(spark, folder):
    rows = I.raw(spark, folder, "status")
    name = C.batch_name(False, F.lit(AS_OF).cast("timestamp_ntz"))
    return C.stamp(rows, name, AS_OF).groupBy("batch_id", "ingested_at", "status").agg(F.count("*").alias("records"))


_ERROR = """concat_ws(';', CASE WHEN r.unique_key IS NULL THEN 'missing unique_key' END,
  CASE WHEN r.created_date = 'invalid' THEN 'unparseable created_date' END)"""


@query("dead_letter_rows", over(RAW, f"""
SELECT unique_key, created_date, status, source_row, batch_id, {_ERROR} AS _error, batch_id AS _batch_id
FROM raw r WHERE {_ERROR} <> ''"""))
def dead_letter_rows(spark, folder):
    rows = I.raw(spark, folder, "unique_key", "created_date", "status", "source_row", "batch_id")
    return L.dead_letters(rows)


@query("accepted_rows", over(FIT, "SELECT unique_key, created_date, status, source_row, batch_id FROM fit"))
def accepted_rows(spark, folder):
    return L.accepted(I.raw(spark, folder, "unique_key", "created_date", "status", "source_row", "batch_id"))


@query("ingest_stats", over(RAW, f"""
SELECT batch_id, count(*) AS fetched, count(*) FILTER (WHERE {_ERROR} = '') AS upserted, count(*) FILTER (WHERE {_ERROR} <> '') AS failed,
  date_diff('second', min(ingested_at), max(ingested_at)) AS duration_seconds,
  round(CAST(count(*) FILTER (WHERE {_ERROR} = '') AS DOUBLE) / greatest(date_diff('second', min(ingested_at), max(ingested_at)), 1), 2) AS records_per_second
FROM raw r GROUP BY batch_id"""))
def ingest_stats(spark, folder):
    return L.ingest_stats(I.raw(spark, folder, "unique_key", "created_date", "ingested_at", "batch_id"))


@query("ingest_observed", ORACLES["ingest_stats"])
def ingest_observed(spark, folder):
    """The statistics of every batch, seen while the batch is written."""
    rows = store(I.raw(spark, folder, "unique_key", "created_date", "ingested_at", "batch_id"), "observed-input")
    batches = [f"batch_{batch}" for batch in range(5)]
    found = [L.observed_stats(rows.where(F.col("batch_id") == batch), batch)[1] for batch in batches]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("record_count_since", over(FIT, f"""
SELECT 'all' AS scope, count(*) AS record_count FROM fit UNION ALL
SELECT 'since', count(*) FROM fit WHERE created_at >= TIMESTAMP '{_SINCE}'"""))
def record_count_since(spark, folder):
    rows = I.with_time(I.fit(spark, folder))
    whole = C.record_count(rows).select(F.lit("all").alias("scope"), "record_count")
    return whole.unionByName(C.record_count(rows, _SINCE).select(F.lit("since").alias("scope"), "record_count"))


@query("seed_sla_policies", over(STAGED, f"""
SELECT CAST(p.policy_no AS INTEGER) AS policy_no, p.agency, p.complaint_type, p.descriptor, CAST(p.sla_days AS INTEGER) AS sla_days,
  p.business_hours_only, count(s.unique_key) AS requests
FROM {policies()} LEFT JOIN stg s ON s.agency_code = p.agency AND s.complaint_type = p.complaint_type GROUP BY ALL"""))
def seed_sla_policies(spark, folder):
    """Every policy row with the number of requests it names; requests are counted per pair before the join."""
    path = fresh_path(spark, "policies")
    policy_frame(spark).write.option("header", True).csv(path)
    seeds = read_policies(spark, path)
    requests = I.staged(spark, folder, "agency", "complaint_type").groupBy(
        F.col("agency_code").alias("agency"), "complaint_type"
    ).agg(F.count("*").alias("requests"))
    return seeds.join(requests, ["agency", "complaint_type"], "left").fillna(0, ["requests"])


@query("adhoc_sql", over(STAGED, """
SELECT agency_code, count(*) AS requests FROM stg WHERE status = 'Open' AND borough = 'BROOKLYN' GROUP BY 1 HAVING count(*) >= 5"""))
def adhoc_sql(spark, folder):
    I.staged(spark, folder, "agency", "status", "borough").createOrReplaceTempView("stg_requests")
    return spark.sql(
        "SELECT agency_code, count(*) AS requests FROM stg_requests WHERE status = :status AND borough = :borough "
        "GROUP BY agency_code HAVING count(*) >= :least",
        args={"status": "Open", "borough": "BROOKLYN", "least": 5},
    )


_FACT_SQL = f"""request_key, created_date_key, closed_date_key, agency_key, complaint_type_key, borough_key, agency_code, agency_name,
  complaint_type, descriptor, complaint_category, borough, incident_zip, status, location_type, resolution_days, CAST(sla_days AS INTEGER) AS sla_days,
  sla_compliant, open_request_age_days, is_emergency, has_coordinates, latitude, longitude, created_at, closed_at"""


@query("mart_roundtrip", over(FACT, f"SELECT {_FACT_SQL} FROM fact"))
def mart_roundtrip(spark, folder):
    """The fact written as a month-partitioned table and read back."""
    path = fresh_path(spark, "fact-months")
    T.write_fact(I.placed_fact(spark, folder).drop("dbt_updated_at"), path, placed=True)
    return T.read_fact(spark, path).drop(T.MONTH)


@query("fact_partition_pruned", over(FACT, """
SELECT agency_key, borough_key, count(*) AS requests FROM fact
WHERE created_month_key_of(created_date_key) BETWEEN DATE '2024-01-01' AND DATE '2024-06-01' GROUP BY 1, 2""".replace(
    "created_month_key_of(created_date_key)", "date_trunc('month', created_date_key)")))
def fact_partition_pruned(spark, folder):
    """Six months read from the stored fact; the other folders are not opened."""
    path = fresh_path(spark, "fact-months")
    T.write_fact(I.fact(spark, folder).select("request_key", "created_date_key", "agency_key", "borough_key"), path)
    rows = T.read_fact(spark, path, "2024-01-01", "2024-06-01")
    return rows.groupBy("agency_key", "borough_key").agg(F.count("*").alias("requests"))
