"""Incremental cursors over the raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.functions.temporal import parse_datetime


def created_at() -> Column:
    return parse_datetime(F.col("created_date"))


def since_filter(df: DataFrame, since: str | Column, created: Column | str = "created_at") -> DataFrame:
    """Rows created at or after ``since``; on a stored timestamp column the comparison reaches the file scan."""
    column = F.col(created) if isinstance(created, str) else created
    bound = F.lit(since).cast("timestamp_ntz") if isinstance(since, str) else since
    return df.where(column >= bound)


def high_water_mark(df: DataFrame, created: str = "created_at") -> DataFrame:
    return df.agg(F.max(created).alias("high_water_mark"))


def lookback_start(
    target: DataFrame, as_of: str, days: int = V.LOOKBACK_DAYS, first_run_days: int = V.FIRST_RUN_DAYS,
    created: str = "created_at",
) -> DataFrame:
    """One row: newest stored creation less the lookback, or ``as_of`` less the first-run span for an empty table."""
    first = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(first_run_days))
    return target.agg(F.coalesce(F.max(created) - F.make_dt_interval(F.lit(days)), first).alias("since"))


def lookback_window(source: DataFrame, target: DataFrame, as_of: str, days: int = V.LOOKBACK_DAYS, created: str = "created_at") -> DataFrame:
    """Source rows inside the lookback window of the target; the bound is a scalar subquery, evaluated once."""
    since = lookback_start(target, as_of, days, created=created)
    return source.where(F.col(created) >= since.scalar())


def full_load(source: DataFrame, start: str = V.FULL_LOAD_START, created: str = "created_at") -> DataFrame:
    return since_filter(source, start, created)


def record_count(df: DataFrame, since: str | None = None, created: str = "created_at") -> DataFrame:
    rows = df if since is None else since_filter(df, since, created)
    return rows.agg(F.count("*").alias("record_count"))


def batch_name(full: bool, moment: Column) -> Column:
    """Batch identifier from the moment of the run."""
    return F.concat(F.lit("full_load_" if full else "batch_"), F.date_format(moment, "yyyyMMdd_HHmmss"))


def stamp(df: DataFrame, batch_id: str | Column, ingested_at: str) -> DataFrame:
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return df.withColumns({"ingested_at": F.lit(ingested_at).cast("timestamp_ntz"), "batch_id": batch})
