"""Suite results from counts stored per batch."""

from pyspark.sql import functions as F

from requestlens.plans import suite as Q
from requestlens.plans.suite_store import SuiteCounts

SUITE = {"expectations": [
    Q.expectation(Q.UNIQUE, "u", "critical", column="k"), Q.expectation(Q.NOT_NULL, "c", "warning", column="v", mostly=0.6),
    Q.expectation(Q.IN_SET, "v", "info", column="v", value_set=["a"]), Q.expectation(Q.ROW_COUNT, "n", "info", min_value=3),
]}


def test_counts_of_batches_add_up(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (None, "b", "x"), (1, "a", "y"), (3, "a", "y"), (3, "c", "z")], "k long, v string, batch string")
    counts = SuiteCounts(spark, str(tmp_path / "counts"), SUITE)
    for batch in ("x", "y", "z", "y"):
        counts.add(rows.where(F.col("batch") == batch), batch)

    def listed(df):
        return sorted(map(tuple, df.collect()))

    assert listed(counts.results()) == listed(Q.evaluate(rows, SUITE))
    assert counts.results().where("expectation_no = 1").first().unexpected_count == 4
    assert listed(counts.results(["y"])) == listed(Q.evaluate(rows.where("batch = 'y'"), SUITE))
    counts.add(rows.limit(0), "empty")
    assert listed(counts.results()) == listed(Q.evaluate(rows, SUITE))
