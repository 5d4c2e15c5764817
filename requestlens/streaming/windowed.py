"""Daily metrics as a stateful aggregate: Spark keeps the open days in its state store and drops them behind the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from requestlens.functions import standardize as S
from requestlens.functions.temporal import parse_datetime, resolution_days
from requestlens.operators.upsert import MONTH, path_exists, write_months
from requestlens.session import store
from requestlens.streaming.ingest import with_event_time

KEYS = ["date_key", "agency_code", "borough"]
MEASURES = ["request_count", "closed_count", "open_count", "resolved_count", "resolution_days_sum"]


def windowed_daily(pages: DataFrame, lookback: str = "7 days") -> DataFrame:
    """Measures per day of creation, agency and borough of a stream of records, for output mode update.

    A record is counted when its day ends after the watermark, which trails the newest creation by ``lookback``; later
    records are dropped. State holds the days that can still change, so its size does not grow with the stream. Every
    record counts, also a further version of a request; ``streaming.daily`` counts requests once, from the upserted table.
    """
    timed = with_event_time(pages).where(F.col("unique_key").isNotNull() & F.col("created_at").isNotNull())
    created, closed = parse_datetime(F.col("created_date")), parse_datetime(F.nullif(F.trim("closed_date"), F.lit("")))
    rows = timed.withWatermark("created_at", lookback).select(
        "created_at", S.upper_trim(F.col("agency")).alias("agency_code"), S.borough(F.col("borough")).alias("borough"), "status",
        resolution_days(created, closed).alias("_days"),
    )
    grouped = rows.groupBy(F.window("created_at", "1 day"), "agency_code", "borough").agg(
        F.count("*").alias("request_count"),
        F.count_if(F.col("status") == "Closed").alias("closed_count"),
        F.count_if(F.col("status") == "Open").alias("open_count"),
        F.count("_days").alias("resolved_count"),
        F.sum("_days").alias("resolution_days_sum"),
    )
    # The start of a window is a zoned instant; its day is taken in UTC, in which the windows lie.
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(F.col("window.start")) / 86400).cast("int"))
    return grouped.select(day.alias("date_key"), "agency_code", "borough", *MEASURES)


def merge_groups(changed: DataFrame, path: str) -> None:
    """Replace the changed groups in the stored daily table.

    Only the months of the changed days are read and written. Values are totals and not increments, so a micro-batch that is
    run again after a failure leaves the table as it is.
    """
    spark = changed.sparkSession
    fresh = store(changed.withColumn(MONTH, F.trunc("date_key", "MONTH")), "windowed-groups")
    # One value per calendar month at most.
    months = [row[0] for row in fresh.select(MONTH).distinct().collect()]
    if not months:
        return
    if path_exists(spark, path):
        known = spark.read.schema(fresh.schema).parquet(path).where(F.col(MONTH).isin(months))
        keys = fresh.select(*[F.col(key).alias(f"_{key}") for key in KEYS])
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in KEYS]
        fresh = store(known.join(keys, same, "left_anti").unionByName(fresh), "windowed-merged")
    write_months(fresh, path)


def start_windowed(
    pages: DataFrame, path: str, checkpoint: str, lookback: str = "7 days", interval: str | None = None
) -> StreamingQuery:
    """Keep the daily table at ``path`` up to date with every micro-batch: on what is there now, or for ever at an interval."""
    writer = (
        windowed_daily(pages, lookback).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(lambda changed, epoch: merge_groups(changed, path))
    )
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_windowed(spark, path: str) -> DataFrame:
    """The stored daily table, with the mean as the quotient of its parts."""
    rows = spark.read.parquet(path).drop(MONTH)
    mean = F.col("resolution_days_sum") / F.nullif(F.col("resolved_count"), F.lit(0))
    return rows.select(*KEYS, *MEASURES[:4], mean.alias("avg_resolution_days"))
