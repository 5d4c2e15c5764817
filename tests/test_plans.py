"""Plans on small fixtures: dimensions, suite, checks, monitors, measures, lineage, summary."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestlens import fixed_values as V
from requestlens.plans import calendar as C
from requestlens.plans import checks as K
from requestlens.plans import dimensions as D
from requestlens.plans import lineage as L
from requestlens.plans import measures as M
from requestlens.plans import monitors as N
from requestlens.plans import suite as Q
from requestlens.plans.enriched import enriched_requests
from requestlens.plans.fact import build_fact, read_fact, write_fact
from requestlens.plans.marts import agency_sla_scorecard, daily_agency_metrics
from requestlens.plans.run_summary import summarize
from requestlens.plans.staging import staged_requests, transformed_records
from requestlens.schemas import FACT_COLUMNS, RAW
from requestlens.sources.seeds import policy_frame

AS_OF = "2024-03-01 00:00:00"
RECORDS = [
    {"unique_key": "n-1", "created_date": "2024-01-17T06:00:00", "closed_date": "2024-01-19T18:00:00", "agency": "NYPD",
     "agency_name": "Precinct desk", "complaint_type": "Noise - Residential", "descriptor": "Drum practice",
     "borough": "Kings", "incident_zip": "11201", "status": "Closed", "latitude": "40.69", "longitude": "-73.98",
     "location": '{"type": "Point", "coordinates": [-73.98, 40.69]}'},
    {"unique_key": "n-2", "created_date": "2024-01-17T06:00:00", "agency": "HPD", "agency_name": "Housing",
     "complaint_type": "Heat/Hot Water", "borough": "BX", "status": "Open"},
    {"unique_key": "n-3", "created_date": "2024-02-20 00:00:00", "closed_date": "2024-02-19", "agency": " hpd ",
     "agency_name": "Housing Dept", "complaint_type": "Heat/Hot Water", "borough": None, "status": "Closed"},
    {"unique_key": None, "created_date": "2024-02-20", "agency": "HPD", "status": "Open"},
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([tuple(r.get(f.name) for f in RAW.fields) for r in RECORDS], RAW)


@pytest.fixture(scope="module")
def enriched(spark, raw):
    return enriched_requests(staged_requests(raw), policy_frame(spark), AS_OF).cache()


def test_transform_records(spark, raw):
    rows = {r.unique_key: r for r in transformed_records(raw, policy_frame(spark, V.LOOKUP_POLICIES), AS_OF).collect()}
    done, waiting = rows["n-1"], rows["n-2"]
    assert (done.borough, done.agency, done.incident_zip, done.complaint_category) == ("BROOKLYN", "NYPD", "11201", "noise")
    assert (done.sla_days, done.sla_compliant, done.location_coordinates) == (30, True, [-73.98, 40.69])
    assert done.has_coordinates and done.open_request_age_days is None
    assert waiting.sla_compliant is None and waiting.open_request_age_days > 0
    assert rows["n-3"].resolution_days is None


def test_enriched(enriched):
    rows = {r.unique_key: r for r in enriched.collect()}
    assert len(rows) == 3
    early = rows["n-3"]
    assert (early.agency_code, early.borough, early.resolution_days, early.sla_compliant) == ("HPD", "UNSPECIFIED", -1.0, True)
    assert str(rows["n-1"].created_week_key) == "2024-01-15" and str(early.created_month_key) == "2024-02-01"
    assert rows["n-2"].is_emergency and rows["n-2"].sla_days == 1


def test_fact_is_the_same_with_and_without_dimension_joins(enriched):
    dims = {"agency": D.dim_agency(enriched), "borough": D.dim_borough(enriched), "complaint_type": D.dim_complaint_type(enriched)}
    joined, computed = build_fact(enriched, dims), build_fact(enriched)
    assert joined.columns == computed.columns == FACT_COLUMNS
    assert sorted(joined.collect(), key=str) == sorted(computed.collect(), key=str)


def test_fact_table_prunes_months(spark, enriched, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(build_fact(enriched), path)
    assert read_fact(spark, path).count() == 3
    some = read_fact(spark, path, "2024-02-01")
    assert some.count() == 1
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month_key" in scan


def test_dim_agency_picks_one_name(spark):
    rows = [("A", "x")] * 2 + [("A", "y")] * 2 + [("A", None)] * 5 + [("B", None)]
    df = spark.createDataFrame(rows, "agency_code string, agency_name string")
    assert {(r.agency_key, r.agency_name) for r in D.dim_agency(df).collect()} == {("A", "x"), ("B", None)}
    assert D.dim_agency(df, one_name=False).count() == 4


def test_dim_date(spark):
    days = D.dim_date(spark).cache()
    assert days.count() == 4017
    assert str(days.agg(F.max("date_key")).first()[0]) == "2030-12-30"
    day = days.where("date_key = DATE '2024-07-04'").first()
    assert (day.quarter, day.day_of_week, day.day_name, day.is_weekend, day.is_federal_holiday) == (3, 4, "Thursday", False, True)
    assert days.where("is_federal_holiday").count() == 3 * 11 - 0
    assert D.dim_date(spark, pad=True).first().month_name == "January  "


def test_suite_definition_round_trip(tmp_path):
    suite = Q.request_suite()
    assert len(suite["expectations"]) == 19
    assert {e["meta"]["severity"] for e in suite["expectations"]} == {"critical", "warning", "info"}
    path = tmp_path / "suite.json"
    Q.save_suite(suite, str(path))
    assert Q.load_suite(str(path)) == suite == json.loads(path.read_text())


def one(spark, rows, schema, kind, **kwargs):
    df = spark.createDataFrame(rows, schema)
    return Q.evaluate(df, {"expectations": [Q.expectation(kind, "d", "critical", **kwargs)]}).first()


def test_expectations(spark):
    result = one(spark, [("a",), ("a",), ("b",), (None,)], "x string", Q.UNIQUE, column="x")
    assert (result.element_count, result.missing_count, result.unexpected_count, result.success) == (4, 1, 2, False)
    result = one(spark, [("a",)] * 9 + [(None,)], "x string", Q.NOT_NULL, column="x", mostly=0.9)
    assert (result.unexpected_percent, result.success) == (10.0, True)
    result = one(spark, [("1",), ("9",), ("z",), (None,)], "x string", Q.BETWEEN, column="x", min_value=1, max_value=5)
    assert (result.unexpected_count, result.success) == (2, False)
    result = one(spark, [("2024-01-02", "2024-01-01"), ("2024-01-01", "2024-01-02"), (None, "2024-01-01")], "a string, b string",
                 Q.BETWEEN, column="a", min_value="{{ b }}", parse_strings_as_datetimes=True)
    assert (result.unexpected_count, result.missing_count) == (1, 1)
    result = one(spark, [("2024-01-01T00:00:00.5",), ("2024-01-01T00:00:00",), ("2024-13-01T00:00:00.5",)], "x string",
                 Q.TEXT_FORMAT, column="x", strftime_format="%Y-%m-%dT%H:%M:%S.%f")
    assert result.unexpected_count == 2
    result = one(spark, [], "x string", Q.IN_SET, column="x", value_set=["a"])
    assert result.success and result.unexpected_percent is None
    assert not one(spark, [], "x string", Q.ROW_COUNT, min_value=1).success


def test_suite_needs_two_scans_only(raw):
    plan = Q.evaluate(raw, Q.request_suite())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_suite_results_are_kept_per_run(spark, raw, tmp_path):
    path = str(tmp_path / "results")
    batch = raw.withColumn("batch_id", F.lit("b1"))
    for run in ("r1", "r2", "r1"):
        Q.save_results(Q.checkpoint_run(batch, Q.request_suite(), run), path)
    assert {(r.run_id, r["count"]) for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {("r1", 19), ("r2", 19)}


def test_gate_ignores_warnings(spark):
    rows = [("critical", True), ("warning", False)]
    gate = Q.gate(spark.createDataFrame(rows, "severity string, success boolean")).first()
    assert tuple(gate) == (True, 0, 1)


def test_fact_checks(enriched):
    checks = {r.check_name: r.failures for r in K.fact_checks(build_fact(enriched)).collect()}
    assert checks["negative_resolution"] == 1 and checks["duplicate_keys"] == 0 and len(checks) == 11
    assert {(r.request_key, r.check_name) for r in K.violations(build_fact(enriched)).collect()} == {("n-3", "negative_resolution")}


def daily(spark, counts, start="2024-01-01"):
    first = dt.date.fromisoformat(start)
    rows = [(first + dt.timedelta(days=i), n) for i, n in enumerate(counts) if n is not None]
    return spark.createDataFrame(rows, "day date, row_count bigint")


def test_row_count_monitors(spark):
    counts = [100, 102, 98, 101, 99] * 6 + [300, 100, 40]
    found = {str(r.day) for r in N.row_count_anomalies(daily(spark, counts)).where("is_anomaly").collect()}
    assert found == {"2024-01-31"}
    drops = {str(r.day) for r in N.row_count_drops(daily(spark, counts)).where("is_drop").collect()}
    assert drops == {"2024-02-01", "2024-02-02"}


def test_null_rate_monitor(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), None if i < (10 if d == 9 else 1) else "x") for d in range(10) for i in range(100)]
    df = spark.createDataFrame(rows, "d date, c string")
    found = N.null_rate_increases(N.null_rates(df, F.col("d"), ["c"])).where("is_increase").collect()
    assert [(str(r.day), r.increase_points) for r in found] == [("2024-01-10", 9.0)]


def test_status_changes(spark):
    rows = [("a", 1, "Open"), ("a", 2, "In Progress"), ("a", 3, "In Progress"), ("a", 4, "Closed"), ("a", 5, "Open"), ("b", 1, "Closed")]
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, d), "r", s) for k, d, s in rows], "unique_key string, ingested_at timestamp, source_row string, status string")
    got = {(r.from_status, r.to_status, r.is_legal) for r in N.status_changes(df).collect()}
    assert got == {("Open", "In Progress", True), ("In Progress", "Closed", True), ("Closed", "Open", False)}


def test_profile_exact_and_approximate_agree_on_small_data(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "x string, y int")
    rows = [sorted(tuple(r) for r in N.profile(df, exact=exact).collect()) for exact in (True, False)]
    assert rows[0] == rows[1] == [("x", 3, 1, 1, "a", "a"), ("y", 3, 1, 2, "1", "3")]


def test_schema_differences():
    actual = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    contract = T.StructType([T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])
    assert N.schema_differences(actual, contract) == [
        ("c", "missing", "string", None), ("a", "unknown", None, "string"), ("b", "retyped", "string", "int")
    ]


def test_calendar_rules(spark):
    rows = [(dt.date(2023, 2, 28), 4), (dt.date(2024, 2, 28), 6), (dt.date(2024, 2, 29), 8), (dt.date(2024, 3, 4), 1)]
    days = spark.createDataFrame(rows, "date_key date, total_requests bigint")
    prior = {str(r.date_key): r.requests_py for r in C.prior_year(days).collect()}
    assert prior["2024-02-28"] == 4 and prior["2024-02-29"] == 4 and prior["2024-03-04"] is None
    means = {str(r.date_key): r.rolling_7d_avg for r in C.rolling_average(days).collect()}
    assert means["2024-03-04"] == 5.0
    filled = {str(r.date_key): r.rolling_7d_avg for r in C.rolling_average(days, zero_fill=True).collect()}
    assert filled["2024-03-04"] == pytest.approx(15 / 7)
    full = C.on_calendar(days, D.dim_date(spark))
    month_end = C.to_date_total(full, "mtd").where("date_key = DATE '2024-02-29'").first()
    assert month_end.requests_mtd == 14


def test_measures_hold_together(spark, enriched):
    fact = build_fact(enriched)
    row = M.measure(fact, list(M.MEASURES)).first()
    assert row.closed_requests + row.open_requests <= row.total_requests == 3
    assert row.sla_compliant_count + row.sla_breached_count == fact.where("sla_compliant is not null").count()
    assert row.avg_resolution_days == pytest.approx(2.5)
    ages = M.aging_buckets(fact, ["agency_key"]).collect()
    for r in ages:
        assert sum(r[c] for c in r.asDict() if c.startswith("open_") and c != "open_requests") == r.open_requests
    top = M.kpi_rollup(fact, ["agency_key", "borough_key"]).where("level_mask = 3").first()
    assert top.total_requests == 3


def test_daily_and_scorecard(enriched):
    metrics = daily_agency_metrics(enriched)
    assert metrics.agg(F.sum("request_count")).first()[0] == 3
    card = agency_sla_scorecard(build_fact(enriched), D.dim_agency(enriched)).collect()
    assert [r.agency_key for r in card] == ["HPD", "NYPD", "HPD"] or {r.agency_key for r in card} == {"HPD", "NYPD"}
    assert all(r.sla_compliance_rate_pct is None or 0 <= r.sla_compliance_rate_pct <= 100 for r in card)


def step(model, source, **columns):
    """A lineage document: each column with the columns it is made of."""
    return {
        "name": model, "source": source, "transformations": [f"build {model}"],
        "columns": {c: {"source_columns": made_of, "transformations": ["as is"]} for c, made_of in columns.items()},
    }


LINEAGE = [
    step("stg", "raw.landed", opened=["raw.landed.opened"], closed=["raw.landed.closed"], place=[]),
    step("enr", "lake.stg", days=["lake.stg.opened", "lake.stg.closed"], target=["seed.policies.target"]),
    step("fact", "enr", met=["enr.days", "enr.target"]),
    step("loop", None, a=["loop.b"], b=["loop.a"]),
    *[step(f"m{i}", f"m{i - 1}", x=[f"m{i - 1}.x"]) for i in range(1, 30)],
]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("metadata")
    for document in LINEAGE:
        (folder / f"{document['name']}.json").write_text(json.dumps(document))
    return L.read_documents(spark, str(folder)).cache()


def test_lineage(documents):
    edges = L.column_edges(documents)
    assert edges.count() == 7 + 29 == L.report(edges).count()
    assert L.model_edges(documents).count() == 3 + 29
    assert L.column_lineage(edges, "stg", "opened").first().source_columns == ["raw.landed.opened"]
    assert L.column_lineage(edges, "stg", "place").count() == 0


def test_lineage_trace(documents):
    edges = L.column_edges(documents)
    depths = {r.source_name: r.depth for r in L.trace(edges, "fact", "met").collect()}
    assert depths == {
        "enr.days": 1, "enr.target": 1, "lake.stg.opened": 2, "lake.stg.closed": 2, "seed.policies.target": 2,
        "raw.landed.opened": 3, "raw.landed.closed": 3,
    }
    assert {r.source_name: r.depth for r in L.trace(edges, "m29", "x").collect()}["m0.x"] == 29
    assert {r.source_name for r in L.trace(edges, "loop", "a").collect()} == {"loop.a", "loop.b"}


def test_run_summary_gates(spark):
    stats = spark.createDataFrame([(10, 10, 0)], "fetched bigint, upserted bigint, failed bigint")
    failed = spark.createDataFrame([(10, 9, 1)], "fetched bigint, upserted bigint, failed bigint")
    results = spark.createDataFrame([("critical", False)], "severity string, success boolean")
    checks = spark.createDataFrame([(False,)], "passed boolean")
    assert summarize(stats, results, checks).first().overall_success
    assert not summarize(stats, results, checks, fail_on_critical=True).first().overall_success
    assert not summarize(failed, results, checks).first().overall_success
    assert not summarize(stats, results, checks, models_built=False).first().overall_success
