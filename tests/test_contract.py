"""Contracts over payloads, landed array pages, and typed times."""

import datetime

from pyspark.sql import functions as F

from requestlens.plans.contract import contract_report, payload_schema
from requestlens.plans.staging import staged_requests
from requestlens.sources import landing


def payloads(spark, *rows):
    return spark.createDataFrame(rows, "batch string, value string, payload string")


def test_unknown_missing_retyped_and_unreadable(spark):
    df = payloads(
        spark, ("a", '{"k": 1, "t": "x", "n": null}', "-"), ("a", '{"k": 2.5, "extra": {"deep": [1]}}', "-"), ("a", "{", "-"), ("a", None, "-"),
        ("b", '{"k": "1", "t": 7, "t2": true}', "-"), ("b", '{"k": "2", "t": "y"}', "-"), ("b", "[1, 2]", "-"),
    )
    found = {(r.batch, r.field): (r.declared_type, r.found_type, r.records, r.retyped, r.status) for r in
             contract_report(df, "value", {"k": "STRING", "t": "STRING", "n": "BIGINT", "t2": "BOOLEAN"}, ["batch"]).collect()}
    assert found == {
        ("a", "k"): ("STRING", "DECIMAL", 2, 2, "retyped"), ("a", "t"): ("STRING", "STRING", 1, 0, "known"),
        ("a", "n"): ("BIGINT", None, 0, 0, "missing"), ("a", "t2"): ("BOOLEAN", None, 0, 0, "missing"),
        ("a", "extra"): (None, "OBJECT", 1, 0, "unknown"), ("a", None): (None, None, 1, 0, "unreadable"),
        ("b", "k"): ("STRING", "STRING", 2, 0, "known"), ("b", "t"): ("STRING", "VARIANT", 2, 1, "retyped"),
        ("b", "n"): ("BIGINT", None, 0, 0, "missing"), ("b", "t2"): ("BOOLEAN", "BOOLEAN", 1, 0, "known"),
    }
    schemas = {r.batch: r.payload_schema for r in payload_schema(df, "value", ["batch"]).collect()}
    assert "extra: OBJECT<deep: ARRAY<BIGINT>>" in schemas["a"]


def test_empty_payloads(spark):
    assert contract_report(payloads(spark).limit(0), "value", {"k": "STRING"}, ["batch"]).count() == 0


def test_array_pages_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), f'say "{i}"', None, f"b{i % 2}") for i in range(50)], "unique_key string, status string, city string, batch_id string")
    landing.land_arrays(rows, str(tmp_path / "p"), ["unique_key", "status", "city"], 7)
    assert len(list((tmp_path / "p").glob("batch_id=*/page=*/*.txt"))) >= 4
    back = landing.read_pages(spark, str(tmp_path / "p")).select("unique_key", "status", "city", "batch_id", landing.CORRUPT)
    assert sorted(map(tuple, back.collect())) == sorted((str(i), f'say "{i}"', None, f"b{i % 2}", None) for i in range(50))


def test_times_as_numbers_and_timestamps(spark):
    df = spark.createDataFrame([("a", 1705314600123, datetime.datetime(2024, 1, 2, 3, 4, 5, 60))], "unique_key string, created_date long, closed_date timestamp_ntz")
    row = staged_requests(df).first()
    assert row.created_at == datetime.datetime(2024, 1, 15, 10, 30, 0, 123000) and row.closed_at == datetime.datetime(2024, 1, 2, 3, 4, 5, 60)
    halves = df.select("unique_key", (F.col("created_date") / 1).alias("created_date"))
    assert staged_requests(halves).first().created_at == row.created_at
