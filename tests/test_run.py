"""Whole runs over landed pages."""

import json

from requestlens.run import run


def page(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def record(key, created, **more):
    return {"unique_key": key, "created_date": created, "agency": "HPD", "agency_name": "Housing", "complaint_type": "Plumbing",
            "borough": "BRONX", "status": "Open", **more}


def test_full_then_incremental_run(spark, tmp_path):
    base = str(tmp_path / "base")
    page(tmp_path / "p1", "a.json", [record("1", "2024-05-01T00:00:00"), record("2", "2024-05-20T00:00:00"), record("0", "2020-01-01")])
    first = run(spark, str(tmp_path / "p1"), base, "2024-05-21 00:00:00", full=True).first()
    assert (first.records_fetched, first.records_failed, first.overall_success, first.tests_success) == (2, 0, True, True)
    fact = spark.read.parquet(f"{base}/curated/fact_service_requests")
    assert {r.request_key for r in fact.collect()} == {"1", "2"}
    tests = spark.read.parquet(f"{base}/monitoring/column_tests")
    assert tests.count() == 38 and {r.status for r in tests.collect()} == {"pass"}
    rates = spark.read.parquet(f"{base}/monitoring/null_rates")
    assert {r.null_rate for r in rates.where("column_name = 'city'").collect()} == {1.0}
    assert spark.read.parquet(f"{base}/reference/sla_policies").count() == 29

    page(tmp_path / "p2", "b.json", [
        record("2", "2024-05-20T00:00:00", status="Closed", closed_date="2024-05-22T00:00:00"),
        record("3", "2024-05-23T00:00:00"), record("4", "2024-05-02T00:00:00"),
    ])
    second = run(spark, str(tmp_path / "p2"), base, "2024-05-24 00:00:00").first()
    assert (second.records_fetched, second.overall_success) == (2, True)
    fact = spark.read.parquet(f"{base}/curated/fact_service_requests")
    assert {(r.request_key, r.status) for r in fact.collect()} == {("1", "Open"), ("2", "Closed"), ("3", "Open")}
    results = spark.read.parquet(f"{base}/raw/suite_results")
    assert {(r.batch_id, r["count"]) for r in results.groupBy("batch_id").count().collect()} == {
        ("full_load_20240521_000000", 19), ("batch_20240524_000000", 19)
    }


def test_rejected_record_stops_the_run(spark, tmp_path):
    page(tmp_path / "p", "a.json", [record("1", "2024-05-01T00:00:00"), record(None, "2024-05-01T00:00:00")])
    row = run(spark, str(tmp_path / "p"), str(tmp_path / "base"), "2024-05-21 00:00:00").first()
    assert (row.records_failed, row.ingestion_success, row.overall_success) == (1, False, False)
    assert not (tmp_path / "base" / "curated").exists()
    assert spark.read.parquet(str(tmp_path / "base" / "raw" / "dead_letters")).count() == 1
