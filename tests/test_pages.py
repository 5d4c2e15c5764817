"""Pages from a stored order."""

import random
import re

import pytest
from pyspark.sql import functions as F

from requestlens.operators.pages import OrderedTable


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(20)]), f"k{i:04d}", "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, slice_name string").repartition(5)
    table = OrderedTable.write(df, str(tmp_path_factory.mktemp("pages") / "t"), ["a", "b"], slices=8)
    return table, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def listed(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize("offset,limit", [(0, 10), (0, 1000), (123, 1), (300, 400), (995, 50), (2000, 5), (10, 0)])
def test_page_by_position(stored, offset, limit):
    table, rows = stored
    assert listed(table.page(offset, limit)) == rows[offset: offset + limit]


@pytest.mark.parametrize("after", [(None, "k0000"), (None, "z"), (3, "k0500"), (3, ""), (19, "z"), (7, "k9")])
@pytest.mark.parametrize("limit", [1, 60, 500])
def test_page_by_key(stored, after, limit):
    table, rows = stored

    def key(row):
        return (row[0] is not None, row[0] or 0, row[1])

    want = [row for row in rows if key(row) > key(after)][:limit]
    assert listed(table.page_after([F.lit(after[0]).cast("int"), F.lit(after[1])], limit)) == want


def test_walking_by_key_visits_every_row_once(stored):
    table, rows = stored
    seen, key = [], [F.lit(None).cast("int"), F.lit("")]
    while page := listed(table.page_after(key, 170)):
        seen += page
        key = [F.lit(page[-1][0]).cast("int"), F.lit(page[-1][1])]
    assert seen == rows


def test_only_slices_of_the_page_are_read(spark, stored):
    table, _ = stored
    bounds = {row.slice: (row.start, row.start + row.rows) for row in table.bounds().collect()}
    page = table.page(bounds[4][0] + 3, 5)
    page.collect()
    scan = page._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert re.search(r"slice#\d+ = 4\b", scan.split("PushedFilters")[0]) and "_at" in scan.split("PushedFilters: [")[1].split("ReadSchema")[0]


def test_counts_of_pages_and_empty_tables(spark, stored, tmp_path):
    table, rows = stored
    counts = {r.page: r.rows for r in table.page_counts(300, "a").collect()}
    assert counts == {0: 300, 1: 300, 2: 300, 3: 100}
    one = OrderedTable.write(spark.createDataFrame([(1, "a")], "a int, b string"), str(tmp_path / "one"), ["a", "b"])
    assert listed(one.page(0, 5)) == [(1, "a")] and listed(one.page(1, 5)) == []
    none = OrderedTable.write(spark.createDataFrame([], "a int, b string"), str(tmp_path / "none"), ["a", "b"])
    assert listed(none.page(0, 5)) == [] and listed(none.page_after([F.lit(1), F.lit("")], 5)) == [] and none.page_counts(5, "a").count() == 0
