"""Counts of a suite kept per batch, so that results over all batches need no row of an earlier one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens.plans.suite import UNIQUE, row_counts, verdicts

BATCH = "suite_batch"


class SuiteCounts:
    """Stored counts of a suite under a folder, partitioned by batch.

    ``counts`` has one row per batch: rows, missing and unexpected values per expectation, which add up. ``keys`` has the
    values of unique columns with their number of rows in the batch, which add up per value: a key that is unique in two
    batches may still be repeated.
    """

    def __init__(self, spark: SparkSession, base: str, suite: dict) -> None:
        self.spark, self.base, self.suite = spark, base, suite
        self.unique = [(number, rule["kwargs"]["column"]) for number, rule in enumerate(suite["expectations"], start=1) if rule["expectation_type"] == UNIQUE]

    def add(self, rows: DataFrame, batch: str) -> None:
        """Count a batch once; repeating it replaces its own counts only."""
        counted = row_counts(rows, self.suite).withColumn(BATCH, F.lit(batch))
        self._write(counted.coalesce(1), "counts")
        for number, column in self.unique:
            keys = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key")).agg(F.count("*").alias("n"))
            self._write(keys.withColumns({"expectation_no": F.lit(number), BATCH: F.lit(batch)}), f"keys/{number}")

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{self.base}/{name}")

    def results(self, batches: list[str] | None = None) -> DataFrame:
        """The suite's results over all stored batches, or over some of them."""
        def chosen(name: str) -> DataFrame:
            rows = self.spark.read.parquet(f"{self.base}/{name}")
            return rows if batches is None else rows.where(F.col(BATCH).isin(batches))

        counts = chosen("counts")
        metrics = counts.agg(*[F.sum(name).alias(name) for name in counts.columns if name != BATCH])
        for number, _ in self.unique:
            merged = chosen(f"keys/{number}").groupBy("key").agg(F.sum("n").alias("n"))
            repeated = merged.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("repeated"))
            metrics = metrics.withColumn(f"_unexpected{number}", repeated.scalar())
        return verdicts(metrics, self.suite)
