"""Daily metrics kept up to date from a stream: the days that a micro-batch touches are computed again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from requestlens.functions import standardize as S
from requestlens.functions.temporal import parse_datetime, resolution_days
from requestlens.operators.dead_letters import with_error
from requestlens.operators.merge import UPDATE, MergedTable
from requestlens.operators.upsert import INSTANT, MONTH, path_exists, write_months
from requestlens.session import store
from requestlens.sources.landing import CORRUPT, conform
from requestlens.streaming.ingest import Stamp, stamp_now, start_stream

KEYS = ["date_key", "agency_code", "borough"]


def daily_metrics(requests: DataFrame) -> DataFrame:
    """Measures per created day, agency and borough of requests, each of which is there once."""
    closed = parse_datetime(F.nullif(F.trim("closed_date"), F.lit("")))
    rows = requests.select(
        F.to_date(INSTANT).alias("date_key"), S.upper_trim(F.col("agency")).alias("agency_code"), S.borough(F.col("borough")).alias("borough"),
        "status", resolution_days(F.col(INSTANT), closed).alias("_days"),
    )
    return rows.groupBy(*KEYS).agg(
        F.count("*").alias("request_count"),
        F.count_if(F.col("status") == "Closed").alias("closed_count"),
        F.count_if(F.col("status") == "Open").alias("open_count"),
        F.count("_days").alias("resolved_count"),
        F.avg("_days").alias("avg_resolution_days"),
    )


def refresh_days(days: DataFrame, requests: DataFrame, path: str) -> None:
    """Replace the given days in the stored daily table by what the requests say now.

    ``days`` is a small stored table. Only the months of these days are read and written; other days of such a month are
    carried over. A day without requests leaves the table.
    """
    spark = requests.sparkSession
    # One value per calendar month at most.
    months = [row[0] for row in days.select(F.trunc("date_key", "MONTH")).distinct().collect()]
    there = requests.where(F.col(MONTH).isin(months))
    fresh = daily_metrics(there.join(days, F.to_date(INSTANT) == F.col("date_key"), "left_semi"))
    if path_exists(spark, path):
        known = spark.read.parquet(path)
        kept = known.where(F.col(MONTH).isin(months)).drop(MONTH).join(days, "date_key", "left_anti")
        fresh = kept.unionByName(fresh)
    write_months(store(fresh.withColumn(MONTH, F.trunc("date_key", "MONTH")), "daily"), path)


def start_daily(
    pages: DataFrame, table_path: str, path: str, checkpoint: str, stamp: Stamp = stamp_now, ties: list[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Merge each micro-batch and compute again the days it touches: those of its rows, and those where their keys lived before.

    So a request counts once, whatever the number of its versions, and late records are counted like others. The days come
    from the change feed of the merge. A replayed micro-batch changes nothing; the days of the last merge are computed
    once more in that case, as the attempt before may have died in between.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        landed = with_error(conform(stamp(batch, epoch)))
        fit = landed.where(F.col("_error").isNull()).drop("_error", CORRUPT)
        table = MergedTable(batch.sparkSession, table_path, ties=ties, even=False)
        before = table.last()
        number = table.merge(fit, f"epoch {epoch}")
        changes = table.changes().where(F.col("merge").between(max(before, 1), number))
        moved = changes.where(F.col("change") == UPDATE)
        days = changes.select(F.to_date(f"after.{INSTANT}").alias("date_key")).union(moved.select(F.to_date(f"before.{INSTANT}"))).distinct()
        if table.exists():
            refresh_days(store(days, "stream-days"), table.rows(), path)

    return start_stream(pages, run, checkpoint, interval)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH)
