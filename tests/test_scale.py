"""Work that grows with the input: how often rows are shuffled and stored, and how evenly they are dealt."""

import datetime as dt
import os


from pyspark.sql import functions as F

from requestlens.plans import fact as T
from requestlens.sources.star_requests import raw_requests


def _star(spark, folder):
    """Small star tables with a key that comes twice and one that has no partner."""
    day = dt.datetime(1996, 3, 1)
    rows = {
        "lineitem": ([(k % 7, k % 3, 1, k % 4, 1.0, 1.0, 0.0, 0.0, "R", "O", day) for k in range(40)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(k, k % 2, "F", 1.0, day, "1") for k in (0, 1, 2, 3, 3, 4, 5)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(k, "c", 0, 1.0, "s") for k in range(2)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "n", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "part": ([(k, "p", "b", "t", 1, 1.0) for k in range(3)], "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_once_to_meet_large_orders(spark, tmp_path, monkeypatch):
    folder = _star(spark, tmp_path)
    monkeypatch.setattr("requestlens.sources.star_requests.LARGE_ORDERS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = raw_requests(spark, folder, ["unique_key", "borough"])
        # One exchange each for lines, orders by customer, orders by key, customers and nations.
        assert _plan(df).count("Exchange hashpartitioning") == 6 and "RoundRobin" not in _plan(df)
        lines = [k % 7 for k in range(40)]
        assert df.count() == sum({3: 2, 6: 0}.get(k, 1) for k in lines)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fact_dealt_by_month_early_is_written_without_another_exchange(spark, tmp_path):
    from requestlens.catalog import inputs as I

    folder = _star(spark, tmp_path / "in")
    assert _plan(I.placed_fact(spark, folder)).count("REBALANCE_PARTITIONS_BY_COL") == _plan(I.fact(spark, folder)).count("REBALANCE_PARTITIONS_BY_COL") + 1
    T.write_fact(I.placed_fact(spark, folder), f"{tmp_path}/placed", placed=True)
    T.write_fact(I.fact(spark, folder), f"{tmp_path}/plain")
    placed, plain = (T.read_fact(spark, f"{tmp_path}/{name}") for name in ("placed", "plain"))
    assert plain.count() > 0 and sorted(map(str, placed.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_pages_and_lines_are_landed_compressed_and_read_back(spark, tmp_path):
    from requestlens.sources import landing as L

    rows = spark.createDataFrame([(f"k{n}", "Open", f"b{n % 2}") for n in range(50)], "unique_key string, status string, batch_id string")
    L.land_arrays(rows, f"{tmp_path}/pages", ["unique_key", "status"], 7, "gzip")
    L.land_lines(rows.repartition(2), f"{tmp_path}/lines", ["unique_key", "status"])
    for name, arrays in (("pages", True), ("lines", False)):
        files = [p.name for p in (tmp_path / name).rglob("part-*")]
        assert files and all(f.endswith(".gz") for f in files)
        back = L.read_pages(spark, f"{tmp_path}/{name}", arrays).select("unique_key", "status", "batch_id")
        assert sorted(back.collect()) == sorted(rows.collect())


def test_turns_get_as_many_files_as_their_rows_need(spark):
    from requestlens.sources.landing import files_per_turn

    rows = spark.range(30_000).withColumn("turn", (F.col("id") % 3 > 0).cast("int"))
    assert files_per_turn(rows, "turn", 4, 10_000_000) == 4
    assert files_per_turn(rows, "turn", 4, 2_500) == 8
    assert files_per_turn(rows, "turn", 4, 10) == 10  # the smaller turn has 10,000 rows
    assert files_per_turn(rows.limit(0), "turn", 4) == 4


def test_stream_pages_are_landed_by_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from requestlens.catalog import streams

    seen = []
    monkeypatch.setattr(streams, "FILE_ROWS", 5)
    monkeypatch.setattr(streams, "land_lines", lambda rows, path, columns: seen.append(rows.rdd.getNumPartitions()))
    monkeypatch.setattr(streams.S, "page_stream", lambda *args, max_files: seen.append(max_files))
    folder = _star(spark, tmp_path / "in")
    streams._pages(spark, folder, 2)
    assert seen == [8, 20]  # 40 lines, two micro-batches of four tasks, which leave up to five files each


def test_months_are_replaced_without_a_second_copy(spark, tmp_path, monkeypatch):
    from requestlens import session
    from requestlens.operators import merge as G
    from requestlens.operators import upsert as U

    stored = []
    for module in (U, G):
        monkeypatch.setattr(module, "store", lambda df, label: stored.append(label) or session.store(df, label))
    schema = "unique_key string, created_date string, status string, ingested_at timestamp_ntz"

    def batch(day, *rows):
        return spark.createDataFrame([(k, c, s, dt.datetime(2024, 6, day)) for k, c, s in rows], schema)

    first = batch(1, ("a", "2024-01-05", "Open"), ("b", "2024-02-05", "Open"), ("c", "2024-01-07", "Open"))
    second = batch(2, ("a", "2024-02-06", "Closed"), ("c", "2024-03-01", "Closed"), ("d", "2024-02-01", "Open"))
    table = G.MergedTable(spark, f"{tmp_path}/merged")
    for number, rows in enumerate((first, second, second)):
        U.upsert_table(rows, f"{tmp_path}/upserted")
        table.merge(rows, f"batch {number}")
    want = {("a", "Closed", "2024-02-01"), ("b", "Open", "2024-02-01"), ("c", "Closed", "2024-03-01"), ("d", "Open", "2024-02-01")}
    for name in ("merged", "upserted"):
        assert {(r.unique_key, r.status, str(r[U.MONTH])) for r in spark.read.parquet(f"{tmp_path}/{name}").collect()} == want
        assert not os.path.exists(f"{tmp_path}/{name}/{U.MONTH}=2024-01-01")
    assert set(stored) == {"upsert-batch", "merge-batch"}


def test_models_are_written_where_they_are_read(spark, tmp_path, monkeypatch):
    from requestlens.plans import incremental as N

    written = []
    monkeypatch.setattr(N, "store", lambda df, label: written.append(label) or df)
    models = N.MonthlyModels(spark, str(tmp_path))
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    rows = spark.createDataFrame([(months[n % 2], n) for n in range(10)], f"{N.MONTH} date, n int")
    assert models._replace(rows, "model", months, placed=True).count() == 10
    assert models._replace(rows.where("n % 2 = 0"), "model", months).count() == 5
    assert [p.name for p in tmp_path.glob("model/created_month=*")] == ["created_month=2024-01-01"] and not written


def test_texts_are_copied_once_on_their_way_to_the_shards(spark, monkeypatch):
    from requestlens.llm import sharding

    copies = {}
    plain = sharding.store
    monkeypatch.setattr(sharding, "store", lambda df, label, *more: copies.setdefault(label, df.schema.simpleString()) and plain(df, label, *more))
    docs = spark.createDataFrame([(n, f"text {n}" if n else None, "x") for n in (0, 1, 2, 3, 3, 3)], "doc_id long, text string, source string")
    found = sharding.shard_documents(docs, 2)
    assert sorted((r.doc_id, r.text or "", r.source) for r in found.collect()) == sorted((r.doc_id, r.text or "", r.source) for r in docs.collect())
    assert copies["numbered"].count("text") == 1


def test_contract_lines_are_landed_compressed_and_parsed_once(spark, tmp_path, monkeypatch):
    from requestlens.catalog import contracts
    from requestlens.plans import contract as C

    calls = []
    plain = C.parsed
    monkeypatch.setattr(contracts, "fresh_path", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(contracts, "FILE_ROWS", 3)
    monkeypatch.setattr(C, "parsed", lambda *args: calls.append(1) or plain(*args))
    report = contracts.mon_contract(spark, _star(spark, tmp_path / "in")).collect()
    files = [p.name for p in (tmp_path / "contract-lines").rglob("part-*")]
    assert len(files) >= 10 and all(f.endswith(".txt.lz4") for f in files) and len(calls) == 1
    assert sum(r.records for r in report if r.field == "complaint_type" or r.status == "unreadable") == 40 - 5 + 6


def test_exact_profile_holds_one_column_at_a_time(spark):
    from requestlens.plans.monitors import profile

    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "n int, t string")
    found = profile(df, exact=True)
    assert "Generate" not in _plan(found)
    assert sorted(map(tuple, found.collect())) == [("n", 3, 0, 2, "1", "2"), ("t", 3, 1, 2, "a", "c")]
    assert profile(df.limit(0), exact=True).count() == 0


def test_many_raw_columns_are_derived_for_chosen_versions_only(spark, tmp_path, monkeypatch):
    from requestlens.catalog import inputs as I

    folder = _star(spark, tmp_path)
    found = I.current(spark, folder, *I.FACT_INPUT, "batch_id")
    # Names of agencies are written after the window, so no exchange carries them.
    assert _plan(found).index("NYPD") < _plan(found).index("Window [")
    monkeypatch.setattr(I, "MANY", 100)
    plain = I.current(spark, folder, *I.FACT_INPUT, "batch_id")
    assert plain.columns == found.columns and _plan(plain).index("NYPD") > _plan(plain).index("Window [")
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() > 0


def test_versions_are_told_apart_where_the_lines_were_dealt(spark, tmp_path, monkeypatch):
    from requestlens.catalog import inputs as I
    from requestlens.operators.latest import latest_wins

    folder = _star(spark, tmp_path)
    monkeypatch.setattr("requestlens.sources.star_requests.LARGE_ORDERS", 0)
    # One order comes twice, once without a date: its newer versions may be unfit and must not hide a fit one.
    day = dt.datetime(1996, 3, 1, 10, 30)
    orders = [(k, 0, "F", 1.0, date, "1") for k, date in [(0, day), (1, day), (2, None), (3, day), (3, None), (4, day), (503, day), (997, day)]]
    spark.createDataFrame(orders, spark.read.parquet(f"{folder}/orders.parquet").schema).write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    lines = [(k, p, s, n, 1.0, 1.0, 0.0, 0.0, "R", "O", day) for k in (0, 1, 2, 3, 4, 503, 997) for p in range(3) for s in (0, 1) for n in (1, None)]
    spark.createDataFrame(lines, spark.read.parquet(f"{folder}/lineitem.parquet").schema).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for columns in (["closed_date"], ["closed_date", "agency", "agency_name", "complaint_type", "location_type", "status"]):
            got = I.current(spark, folder, *columns)
            # One exchange each for lines and orders.
            assert _plan(got).count("Exchange") == 2
            expected = latest_wins(I.fit(spark, folder, *columns), ties=I.TIES)
            assert got.columns == expected.columns and got.count() == 3
            assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_suites_store_keys_and_flags_instead_of_texts(spark, tmp_path):
    from requestlens.catalog import QUERIES

    folder = _star(spark, tmp_path)
    for name, kept in (("x_gate", set()), ("x_suite_by_day", {"created_day"})):
        files = QUERIES[name](spark, folder).inputFiles()
        assert files and all("/suite-flags-" in file for file in files)
        read = set(spark.read.parquet(os.path.dirname(files[0])).columns)
        assert {"unique_key", "_null_agency", "_wrong12", *kept} <= read
        assert all(column in {"unique_key", *kept} or column.startswith("_") for column in read)


def test_flagged_rows_give_the_results_of_the_rows(spark):
    from requestlens.plans import suite as Q

    rules = [
        Q.expectation(Q.NOT_NULL, "d", "critical", column="k"),
        Q.expectation(Q.UNIQUE, "d", "critical", column="k"),
        Q.expectation(Q.UNIQUE, "d", "critical", column="x"),
        Q.expectation(Q.IN_SET, "d", "info", column="x", value_set=["1", "2"]),
        Q.expectation(Q.BETWEEN, "d", "info", column="x", min_value=0, max_value=1.5),
        Q.expectation(Q.ROW_COUNT, "d", "info", min_value=1, max_value=3),
    ]
    suite = {"expectations": rules}
    rows = spark.createDataFrame(
        [("a", "1", 1), ("a", "2", 1), (None, "3", 1), (None, None, None), ("b", "x", None), ("b", "x", 2), ("c", None, 2)],
        "k string, x string, g int",
    )
    for by in ([], ["g"], ["k"]):
        flagged = Q.flagged(rows, suite, by)
        assert set(flagged.columns) == {"k", "x", *by, "_null_k", "_null_x", "_wrong4", "_wrong5"}
        expected = Q.evaluate(rows, suite, by).collect()
        assert len(expected) == 6 * len({tuple(row[name] for name in by) for row in rows.collect()})
        assert sorted(map(str, Q.evaluate_flagged(flagged, suite, by).collect())) == sorted(map(str, expected))


def test_pages_are_dealt_to_many_tasks_before_columns_are_derived(spark, tmp_path, monkeypatch):
    from requestlens.catalog import ingest
    from requestlens.sources import landing as L

    monkeypatch.setattr(L, "TASK_PAGES", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(300).select(F.col("id").cast("string").alias("unique_key"), F.lit("b").alias("batch_id"))
        dealt = L.deal_pages(rows, 10, ["unique_key"])
        # One batch, and yet no task has all of it: 30 pages go to 15 tasks, none of them to two.
        assert dealt.rdd.getNumPartitions() == 15 and "SortMergeJoin" not in _plan(dealt)
        places = dealt.select("page", F.spark_partition_id().alias("task")).distinct().collect()
        assert dealt.count() == 300 and len({r.page for r in places}) == len(places) and len({r.task for r in places}) > 5
        seen = {}
        monkeypatch.setattr(ingest.landing, "land_arrays", lambda df, *args, dealt: seen.update(plan=_plan(df), rows=df.count(), fields=df.columns))
        folder = _star(spark, tmp_path / "in")
        ingest.src_json_pages(spark, folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert seen["rows"] == raw_requests(spark, folder).count() and "incident_address" in seen["fields"]
    exchanged = [line for line in seen["plan"].splitlines() if "Exchange hashpartitioning(batch_id" in line and "REPARTITION_BY_NUM" in line]
    # What is derived stands above the exchange, so texts like the address are not shuffled.
    assert len(exchanged) == 1 and "upper(p_name" in seen["plan"][: seen["plan"].index(exchanged[0])]


def test_rows_without_a_mark_are_not_shuffled(spark):
    from requestlens.operators.key_marks import KeyMarks

    rows = spark.range(20_000).select(F.when(F.col("id") != 7, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    keys = spark.range(0, 20_000, 50).select(F.col("id").cast("string").alias("k"))
    free, doubtful = KeyMarks(keys, "k").split(rows)
    assert "Exchange hashpartitioning" not in _plan(free) and free.columns == doubtful.columns == rows.columns
    kept, rest = ({r.v for r in df.collect()} for df in (free, doubtful))
    assert kept | rest == set(range(20_000)) and not kept & rest
    assert 7 in rest and set(range(0, 20_000, 50)) <= rest and len(rest) < 2_000
    none = KeyMarks(keys.limit(0), "k").split(rows)
    assert [df.count() for df in none] == [19_999, 1]


def test_merges_of_repeated_keys_against_a_plain_one(spark, tmp_path):
    import random

    from requestlens.operators.merge import MergedTable
    from requestlens.session import store

    rng = random.Random(3)
    schema = "unique_key string, created_date string, status string, ingested_at timestamp_ntz"
    tables = [MergedTable(spark, f"{tmp_path}/{even}", even=even) for even in (True, False)]
    state, ledger = {}, []
    for number in range(3):
        rows = [(str(rng.randint(0, 60)), f"2024-{rng.randint(1, 4):02d}-{rng.randint(1, 28):02d}", f"s{n}", dt.datetime(2024, 6, 1, rng.randint(0, 5), n % 60))
                for n in range(50)]
        best = {}
        for row in rows:
            best[row[0]] = max(best.get(row[0], row), row, key=lambda r: (r[3], r[1], r[2]))
        newer = {k: r for k, r in best.items() if k not in state or (r[3], r[1], r[2]) > (state[k][3], state[k][1], state[k][2])}
        ledger.append((len(newer.keys() - state.keys()), len(newer.keys() & state.keys()), len(best) - len(newer)))
        batch = spark.createDataFrame(rows, schema)
        tables[0].merge(batch, "b")
        tables[1].merge(store(batch, "batch"), "b", stored=True)
        state |= newer
        for table in tables:
            assert {tuple(r) for r in table.rows().select("unique_key", "created_date", "status", "ingested_at").collect()} == set(state.values())
            assert table.rows().count() == len(state) and {r.unique_key for r in table.changes(number + 1).collect()} == newer.keys()
    for table in tables:
        assert [tuple(r) for r in table.ledger().orderBy("merge").select("inserted", "updated", "unchanged").collect()] == ledger


def test_lines_are_dealt_to_micro_batches_before_columns_are_derived(spark, tmp_path, monkeypatch):
    from requestlens.catalog import streams

    seen = []
    monkeypatch.setattr(streams, "land_lines", lambda rows, path, columns: seen.append(_plan(rows)))
    monkeypatch.setattr(streams.S, "page_stream", lambda *args, max_files: None)
    streams._pages(spark, _star(spark, tmp_path / "in"), 2)
    dealt = seen[0].index("REPARTITION_BY_NUM")
    assert "batch_" in seen[0][:dealt] and "batch_" not in seen[0][dealt:]
