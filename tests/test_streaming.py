"""Streaming jobs against the batch result, over several micro-batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from requestlens.operators.latest import latest_wins
from requestlens.operators.upsert import INSTANT, MONTH
from requestlens.streaming import daily as D
from requestlens.streaming import ingest as S
from requestlens.streaming import windowed as W


def land(folder, batch, records, extra=""):
    target = folder / f"batch_id={batch}"
    target.mkdir(parents=True)
    (target / "page.json").write_text("\n".join(json.dumps(r) for r in records) + extra)


def record(key, created, status="Open", **more):
    return {"unique_key": key, "created_date": created, "status": status, "agency": "NYPD", "borough": "BX", **more}


def stamp(batch, epoch):
    return batch.withColumn("ingested_at", F.col("ingested_at").try_cast("timestamp_ntz"))


def test_upsert_stream(spark, tmp_path):
    pages = tmp_path / "pages"
    land(pages, "b1", [record("a", "2024-01-01", ingested_at="2024-06-01 00:00:00"), record("b", "2024-01-01", ingested_at="2024-06-01 00:00:00")])
    land(pages, "b2", [record("a", "2024-02-01", "Closed", ingested_at="2024-06-02 00:00:00"), record(None, "2024-01-01")], '\n{"unique_key": "c", "crea')
    land(pages, "b3", [record("c", "soon"), record("d", "2024-02-03", ingested_at="2024-06-03 00:00:00")])

    def run():
        stream = S.page_stream(spark, str(pages), ("ingested_at",), max_files=1)
        S.start_upsert(stream, str(tmp_path / "table"), str(tmp_path / "rejected"), str(tmp_path / "checkpoint"), stamp).awaitTermination()
        return {r.unique_key: (r.status, str(r[MONTH])) for r in spark.read.parquet(str(tmp_path / "table")).collect()}

    want = {"a": ("Closed", "2024-02-01"), "b": ("Open", "2024-01-01"), "d": ("Open", "2024-02-01")}
    assert run() == want
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    assert sorted(r._error for r in rejected.collect()) == [
        "corrupt record;missing unique_key;unparseable created_date", "missing unique_key", "unparseable created_date"
    ]
    land(pages, "b4", [record("b", "2024-01-01", "Pending", ingested_at="2024-06-04 00:00:00")])
    assert run() == {**want, "b": ("Pending", "2024-01-01")}


def test_dedup_stream(spark, tmp_path):
    pages = tmp_path / "pages"
    land(pages, "b1", [record("a", "2024-01-01"), record("a", "2024-01-02"), record("b", "2024-01-02")])
    land(pages, "b2", [record("a", "2024-01-03"), record("c", "2024-01-04")])
    query = (
        S.deduplicated(S.page_stream(spark, str(pages), max_files=1)).select("unique_key").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.unique_key for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_daily_stream_counts_each_request_once(spark, tmp_path, zone):
    pages = tmp_path / "pages"

    def run():
        stream = S.page_stream(spark, str(pages), ("ingested_at",), max_files=1)
        D.start_daily(stream, str(tmp_path / "table"), str(tmp_path / "daily"), str(tmp_path / "checkpoint"), stamp).awaitTermination()
        return {str(r.date_key): (r.request_count, r.closed_count) for r in D.read_daily(spark, str(tmp_path / "daily")).collect()}

    at = {"ingested_at": "2024-06-01 00:00:00"}
    land(pages, "b1", [record("a", "2024-03-01", **at), record("b", "2024-03-10", **at)])
    assert run() == {"2024-03-01": (1, 0), "2024-03-10": (1, 0)}
    at = {"ingested_at": "2024-06-02 00:00:00"}
    land(pages, "b2", [record("c", "2024-03-20", **at), record("b", "2024-03-10", "Closed", closed_date="2024-03-11", **at)])
    assert run() == {"2024-03-01": (1, 0), "2024-03-10": (1, 1), "2024-03-20": (1, 0)}
    at = {"ingested_at": "2024-06-03 00:00:00"}
    # A late record, and one that moves to another day and month.
    land(pages, "b3", [record("e", "2024-03-01", **at), record("c", "2024-04-02", **at)])
    assert run() == {"2024-03-01": (2, 0), "2024-03-10": (1, 1), "2024-04-02": (1, 0)}


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    from requestlens.operators.upsert import upsert_table

    rows = spark.createDataFrame([("a", "2024-01-01", "x", 1), ("a", "2024-01-01", "y", 2)], "unique_key string, created_date string, status string, ingested_at int")
    for _ in range(2):
        upsert_table(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).drop(MONTH, INSTANT).collect() == latest_wins(rows).collect()


def landed_by_turn(spark, folder, turns):
    for number, records in enumerate(turns):
        folder.mkdir(exist_ok=True)
        (folder / f"{number}.json").write_text("\n".join(json.dumps({**r, "batch_id": str(number)}) for r in records))
        os.utime(folder / f"{number}.json", (1_700_000_000 + number, 1_700_000_000 + number))


def test_windowed_days_are_kept_and_dropped_by_spark(spark, tmp_path):
    turns = [
        [record("a", "2024-01-01T10:00:00"), record("b", "2024-01-01T11:00:00", "Closed", closed_date="2024-01-03T11:00:00")],
        [record("c", "2024-02-01T10:00:00"), record("d", "2024-01-01T12:00:00"), record(None, "2024-02-01"), record("x", "soon")],
        [record("e", "2024-03-01T10:00:00"), record("f", "2024-01-01T13:00:00"), record("g", "2024-02-01T13:00:00")],
        [record("h", "2024-03-02T10:00:00"), record("i", "2024-02-01T14:00:00"), record("j", "2024-02-24T14:00:00")],
        [record("l", "2024-03-03T10:00:00"), record("m", "2024-02-01T15:00:00"), record("n", "2024-01-01T15:00:00")],
    ]
    landed_by_turn(spark, tmp_path / "pages", turns)

    def run():
        stream = S.page_stream(spark, str(tmp_path / "pages"), max_files=1)
        query = W.start_windowed(stream, str(tmp_path / "daily"), str(tmp_path / "checkpoint"), "7 days")
        query.awaitTermination()
        return query.recentProgress, {str(r.date_key): tuple(r)[3:] for r in W.read_windowed(spark, str(tmp_path / "daily")).collect()}

    progress, days = run()
    # Rows are judged by the newest creation of the turns before the previous one: m and n come after 2024-02-23, all others in time.
    assert days == {
        "2024-01-01": (4, 1, 3, 1, 2.0), "2024-02-01": (3, 0, 3, 0, None), "2024-02-24": (1, 0, 1, 0, None),
        "2024-03-01": (1, 0, 1, 0, None), "2024-03-02": (1, 0, 1, 0, None), "2024-03-03": (1, 0, 1, 0, None),
    }
    state = [p.stateOperators[0] for p in progress]
    assert sum(s.numRowsRemoved for s in state) >= 2 and sum(s.numRowsDroppedByWatermark for s in state) == 2
    assert state[-1].numRowsTotal <= 4
    landed_by_turn(spark, tmp_path / "more", [[record("k", "2024-03-02T11:00:00")]])
    (tmp_path / "more" / "0.json").rename(tmp_path / "pages" / "9.json")
    assert run()[1]["2024-03-02"] == (2, 0, 2, 0, None)


def test_groups_merge_with_missing_names_and_replays(spark, tmp_path):
    path, schema = str(tmp_path / "daily"), "date_key date, agency_code string, borough string, request_count long, resolution_days_sum double"

    def merge(*rows):
        df = spark.createDataFrame([(d, a, b, n, 1.0) for d, a, b, n in rows], schema.replace("date_key date", "date_key string"))
        W.merge_groups(df.withColumn("date_key", F.to_date("date_key")), path)
        return {(str(r.date_key), r.agency_code, r.borough): r.request_count for r in spark.read.parquet(path).collect()}

    merge(("2024-01-01", None, "BRONX", 1), ("2024-01-02", "HPD", "BRONX", 1), ("2024-02-01", "HPD", None, 5))
    want = {("2024-01-01", None, "BRONX"): 2, ("2024-01-02", "HPD", "BRONX"): 1, ("2024-02-01", "HPD", None): 5}
    assert merge(("2024-01-01", None, "BRONX", 2)) == want
    assert merge(("2024-01-01", None, "BRONX", 2)) == want
    assert merge() == want


def test_a_key_returns_after_the_horizon(spark, tmp_path):
    days = ["2024-01-01", "2024-01-20", "2024-02-20", "2024-03-20", "2024-04-20"]
    turns = [[record("a", day), record(str(n), day)] for n, day in enumerate(days)]
    turns[1].append(record("0", "2024-01-02"))
    landed_by_turn(spark, tmp_path / "pages", turns)
    query = (
        S.deduplicated(S.page_stream(spark, str(tmp_path / "pages"), max_files=1), "7 days").select("unique_key", "created_date").writeStream
        .format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = sorted((r.unique_key, r.created_date) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # The watermark passes the first record by the horizon in the third turn, and the state is forgotten at its end.
    assert [d for k, d in found if k == "a"] == ["2024-01-01", "2024-03-20"]
    assert [k for k, _ in found if k != "a"] == ["0", "1", "2", "3", "4"]
    assert sum(p.stateOperators[0].numRowsRemoved for p in query.recentProgress) >= 3
