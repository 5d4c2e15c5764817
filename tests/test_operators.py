"""Operators against brute force on small inputs, including keys that hold most of the rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from requestlens.operators import cursor, dead_letters, policies, row_index
from requestlens.operators.latest import latest_wins
from requestlens.operators.quantiles import aggregate_with_quantile, grouped_quantile
from requestlens.operators.upsert import MONTH, upsert, upsert_counts, upsert_table
from requestlens.sources.landing import CORRUPT, conform, read_pages, with_payload
from requestlens.sources.seeds import policy_frame, read_policies


def versions(spark, rows):
    return spark.createDataFrame(
        rows, "unique_key string, created_date string, status string, ingested_at string"
    ).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def test_latest_wins_with_hot_key(spark):
    rows = [("hot", "2024-01-01", f"s{i:04d}", "2024-02-01") for i in range(3000)] + [
        (f"k{i}", "2024-01-01", "a", "2024-02-01") for i in range(50)
    ] + [(f"k{i}", "2024-01-01", "b", "2024-02-02") for i in range(0, 50, 2)]
    got = {row.unique_key: row.status for row in latest_wins(versions(spark, rows)).collect()}
    assert len(got) == 51 and got["hot"] == "s2999" and got["k0"] == "b" and got["k1"] == "a"


def test_latest_wins_limits_before_the_shuffle(spark):
    plan = latest_wins(versions(spark, [("a", "2024-01-01", "x", "2024-01-01")]))._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_upsert_counts_and_frame(spark):
    target = versions(spark, [("a", "2024-01-01", "Open", "2024-01-02"), ("b", "2024-01-01", "Open", "2024-01-02")])
    batch = versions(spark, [("b", "2024-01-01", "Closed", "2024-01-03"), ("c", "2024-01-01", "Open", "2024-01-03")])
    once = upsert(target, batch)
    twice = upsert(once, batch)
    want = {("a", "Open"), ("b", "Closed"), ("c", "Open")}
    assert {(r.unique_key, r.status) for r in once.collect()} == want == {(r.unique_key, r.status) for r in twice.collect()}
    assert tuple(upsert_counts(target, batch).first()) == (2, 1, 1)
    assert tuple(upsert_counts(target.limit(0), batch).first()) == (2, 2, 0)


def test_upsert_table_moves_rows_between_months(spark, tmp_path):
    path = str(tmp_path / "requests")
    upsert_table(versions(spark, [
        ("a", "2024-01-05", "Open", "2024-03-01"), ("b", "2024-02-05", "Open", "2024-03-01"), ("c", "2024-03-05", "Open", "2024-03-01"),
    ]), path)
    untouched = sorted(p.name for p in (tmp_path / "requests" / f"{MONTH}=2024-03-01").glob("*.parquet"))
    change = versions(spark, [("a", "2024-02-06", "Closed", "2024-03-02")])
    for _ in range(2):
        upsert_table(change, path)
    rows = {r.unique_key: (r.status, str(r[MONTH])) for r in spark.read.parquet(path).collect()}
    assert rows == {"a": ("Closed", "2024-02-01"), "b": ("Open", "2024-02-01"), "c": ("Open", "2024-03-01")}
    assert sorted(p.name for p in (tmp_path / "requests" / f"{MONTH}=2024-03-01").glob("*.parquet")) == untouched


@pytest.mark.parametrize("quantile", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_grouped_quantile(spark, quantile):
    source = random.Random(7)
    rows = [("hot", round(source.gauss(3, 2), 3)) for _ in range(2000)]
    rows += [(f"g{i % 7}" if i % 7 else None, round(source.uniform(-5, 400), 2)) for i in range(300)]
    rows += [("one", 2.5), ("even", 1.0), ("even", 2.0), ("empty", None), ("same", 4.0), ("same", 4.0), ("same", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {row.g: row.q for row in grouped_quantile(df, ["g"], "v", "q", quantile).collect()}
    groups = {g: [v for h, v in rows if h == g and v is not None] for g, _ in rows}
    assert got.keys() == {g for g, vs in groups.items() if vs}
    for group, value in got.items():
        assert value == pytest.approx(float(np.quantile(groups[group], quantile)))


@pytest.mark.parametrize("spread", [300.0, 0.5, 1e-6])
def test_quantile_divides_large_buckets(spark, spread):
    source = random.Random(11)
    rows = [("hot", source.random() * spread - spread / 3) for _ in range(3000)] + [("few", 1.5), ("few", 2.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {row.g: row.q for row in grouped_quantile(df, ["g"], "v", "q", 0.5, largest_bucket=5).collect()}
    assert got == pytest.approx({"hot": float(np.median([v for g, v in rows if g == "hot"])), "few": 2.0}, rel=1e-12)


def test_aggregate_with_quantile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0)], "g string, v double")
    count = F.count("*").alias("n")
    got = aggregate_with_quantile(df, ["g"], [count], "v", "m").collect()
    assert {tuple(row) for row in got} == {("a", 2, 1.5), ("b", 1, None), (None, 1, 4.0)}
    whole = aggregate_with_quantile(df, [], [count], "v", "m").first()
    assert tuple(whole) == (4, 2.0)


def test_row_index_and_pages(spark):
    source = random.Random(3)
    keys = [(source.randrange(40), i) for i in range(1000)]
    df = spark.createDataFrame(keys, "a int, b int").repartition(6)
    order = [F.asc("a"), F.asc("b")]
    got = {(r.a, r.b): r.row_index for r in row_index.with_row_index(df, order).collect()}
    assert got == {key: number for number, key in enumerate(sorted(keys))}
    for offset, limit in ((0, 10), (400, 100), (990, 100)):
        page = row_index.fetch_page(df, order, offset, limit).collect()
        assert [(r.a, r.b) for r in page] == sorted(keys)[offset: offset + limit]


def test_consecutive_pairs_with_hot_key(spark):
    rows = [("hot", i, i % 3) for i in range(800)] + [(f"k{i}", j, j) for i in range(20) for j in range(2)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    pairs = row_index.consecutive_pairs(df, "k", [F.asc("t")], ["t", "v"]).collect()
    assert len(pairs) == 799 + 20
    assert all(p.previous_t == p.t - 1 for p in pairs)


def test_policy_matches(spark):
    rules = [
        ("A", "x", None, 1, False), ("A", "x", "d1", 2, False), ("A", "*", None, 3, False), ("A", "*", "d2", 4, False),
        ("A", "x", "*", 9, False), ("*", "*", None, 30, False),
    ]
    requests = [("A", "x", "d1"), ("A", "x", "d9"), ("A", "y", "d2"), ("A", "y", None), ("B", "x", "d1"), (None, None, None)]
    df = spark.createDataFrame(requests, "agency_code string, complaint_type string, descriptor string")
    p = policy_frame(spark, rules)
    best = {tuple(r)[:3]: r.sla_days for r in policies.with_best_policy(df, p).collect()}
    assert [best[r] for r in requests] == [2, 1, 4, 3, 30, 30]
    first = {tuple(r)[:3]: r.sla_days for r in policies.with_first_policy(df, p, "agency_code").collect()}
    assert [first[r] for r in requests] == [1, 1, 30, 30, 30, 30]
    every = policies.with_all_policies(df, p)
    counts = {tuple(r)[:3]: r["count"] for r in every.groupBy(*df.columns).count().collect()}
    assert [counts[r] for r in requests] == [4, 3, 2, 1, 1, 1]


def test_policy_lookup_examples(spark):
    from requestlens import fixed_values as V

    rows = [("NYPD", "Noise - Residential"), ("HPD", "Heat/Hot Water"), ("DSNY", "Missed Collection"), ("X", "y"), ("HPD", "heat/hot water")]
    df = spark.createDataFrame([(a, t, None) for a, t in rows], "agency string, complaint_type string, descriptor string")
    got = {(r.agency, r.complaint_type): r.sla_days for r in policies.with_first_policy(df, policy_frame(spark, V.LOOKUP_POLICIES), "agency").collect()}
    assert [got[r] for r in rows] == [30, 1, 2, 30, 30]


def test_policy_join_is_broadcast_without_fan_out(spark):
    df = spark.createDataFrame([("NYPD", "Illegal Parking", str(i)) for i in range(10)], "agency_code string, complaint_type string, descriptor string")
    joined = policies.with_best_policy(df, policy_frame(spark))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan and "NestedLoop" not in plan
    assert joined.count() == 10


def test_policies_from_csv(spark, tmp_path):
    path = tmp_path / "policies.csv"
    path.write_text("policy_no,agency,complaint_type,descriptor,sla_days,business_hours_only\n7,NYPD,Noise,,30,false\n9,*,*,,30,true\n")
    rows = read_policies(spark, str(path)).orderBy("policy_no").collect()
    assert [tuple(r) for r in rows] == [(7, "NYPD", "Noise", None, 30, False), (9, "*", "*", None, 30, True)]


def test_pages_with_corrupt_input(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"unique_key": "1", "created_date": "2024-01-01", "location": {"type": "Point"}}, {"unique_key": "2"}]')
    (tmp_path / "cut.json").write_text('[{"unique_key": "3", "created_da')
    pages = read_pages(spark, str(tmp_path)).cache()
    assert pages.count() == 3
    marked = {r.unique_key: r._error for r in dead_letters.with_error(pages).collect()}
    assert marked["1"] is None and marked["2"] == "unparseable created_date"
    assert "corrupt record" in marked[None]
    assert pages.where(F.col("unique_key") == "1").first().location == '{"type": "Point"}'
    fit = dead_letters.accepted(pages)
    assert fit.count() == 1 and CORRUPT in fit.columns


def test_split_write_keeps_every_row(spark, tmp_path):
    df = versions(spark, [("a", "2024-01-01", "x", "2024-01-01"), (None, "bad", "x", "2024-01-01")]).withColumn("batch_id", F.lit("b"))
    dead_letters.write_split(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.rejected, r._error) for r in back.collect()} == {("false", None), ("true", "missing unique_key;unparseable created_date")}


def test_cursor(spark):
    rows = spark.createDataFrame([("a", dt.datetime(2024, 5, 1)), ("b", dt.datetime(2024, 5, 20))], "k string, t timestamp").select(
        "k", F.col("t").cast("timestamp_ntz").alias("created_at")
    )
    assert cursor.lookback_start(rows, "2024-06-01").first().since == dt.datetime(2024, 5, 13)
    assert cursor.lookback_start(rows.limit(0), "2024-06-01").first().since == dt.datetime(2024, 5, 2)
    assert cursor.high_water_mark(rows.limit(0)).first().high_water_mark is None
    assert [r.k for r in cursor.lookback_window(rows, rows, "2024-06-01").collect()] == ["b"]
    assert [r.k for r in cursor.since_filter(rows, "2024-05-20 00:00:00").collect()] == ["b"]
    name = spark.range(1).select(cursor.batch_name(True, F.lit("2024-05-01 02:03:04").cast("timestamp_ntz")).alias("n")).first().n
    assert name == "full_load_20240501_020304"


def test_conform_and_payload(spark):
    df = spark.createDataFrame([("1", None)], "unique_key string, city string")
    full = conform(df)
    assert full.first().latitude is None and "batch_id" in full.columns
    assert with_payload(df).first().raw_payload == '{"unique_key":"1"}'


def test_statistics_are_observed_while_a_batch_is_written(spark):
    from requestlens.operators import dead_letters

    rows = spark.createDataFrame(
        [("a", "2024-01-01", "2024-06-01 00:00:00", "b"), (None, "2024-01-01", "2024-06-01 00:00:10", "b"), ("c", "soon", None, "b")],
        "unique_key string, created_date string, ingested_at string, batch_id string",
    ).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))
    stored, stats = dead_letters.observed_stats(rows, "b")
    assert stats.collect() == dead_letters.ingest_stats(rows).select(stats.columns).collect()
    assert stored.where("_error IS NULL").count() == 1
    nothing = dead_letters.observed_stats(rows.limit(0), "b")[1].first()
    assert (nothing.fetched, nothing.upserted, nothing.failed, nothing.duration_seconds) == (0, 0, 0, None)
