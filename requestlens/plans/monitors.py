"""Monitors over time: volume, nulls, freshness, completeness, drift, status changes, profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestlens import fixed_values as V
from requestlens.operators.row_index import consecutive_pairs


def daily_counts(df: DataFrame, day: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.where(day.isNotNull()).groupBy(*by, day.alias("day")).agg(F.count("*").alias("row_count"))


def _trailing(day: str, days: int, by: Sequence[str]) -> Window:
    """The ``days`` days before each day. Runs on day-level rows only, a few thousand per group."""
    number = F.date_diff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return window.orderBy(number).rangeBetween(-days, -1)


def row_count_anomalies(
    daily: DataFrame, by: Sequence[str] = (), days: int = 30, sigmas: float = V.ROW_COUNT_SIGMAS
) -> DataFrame:
    """Days whose count lies more than ``sigmas`` standard deviations from the mean of the days before."""
    past = _trailing("day", days, by)
    mean, spread = F.avg("row_count").over(past), F.stddev_samp("row_count").over(past)
    score = (F.col("row_count") - F.col("mean_30d")) / F.nullif(F.col("stddev_30d"), F.lit(0.0))
    scored = daily.withColumns({"mean_30d": mean, "stddev_30d": spread}).withColumn("z_score", score)
    return scored.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > sigmas, F.lit(False)))


def row_count_drops(daily: DataFrame, by: Sequence[str] = (), drop: float = V.ROW_COUNT_DROP) -> DataFrame:
    """Change against the previous day with rows."""
    window = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("day")
    change = F.col("row_count") / F.col("previous_count") - 1
    compared = daily.withColumn("previous_count", F.lag("row_count").over(window)).withColumn("change", change)
    return compared.withColumn("is_drop", F.coalesce(F.col("change") < -drop, F.lit(False)))


def null_rates(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """Null share per day and column from one aggregate."""
    counted = df.where(day.isNotNull()).groupBy(day.alias("day")).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(name).isNull()).alias(f"_{name}") for name in columns]
    )
    entries = [
        F.struct(F.lit(name).alias("column_name"), (F.col(f"_{name}") / F.col("_rows")).alias("null_rate")) for name in columns
    ]
    return counted.select("day", F.inline(F.array(*entries)))


def null_rate_increases(rates: DataFrame, days: int = 30, points: float = V.NULL_RATE_INCREASE_POINTS) -> DataFrame:
    past = _trailing("day", days, ["column_name"])
    compared = rates.withColumn("baseline_rate", F.avg("null_rate").over(past))
    increase = F.round(F.lit(100.0) * (F.col("null_rate") - F.col("baseline_rate")), 6)
    compared = compared.withColumn("increase_points", increase)
    return compared.withColumn("is_increase", F.coalesce(F.col("increase_points") > points, F.lit(False)))


def freshness(df: DataFrame, column: str, as_of: str, max_hours: float = V.MAX_DATA_AGE_HOURS) -> DataFrame:
    newest = df.agg(F.max(column).alias("newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), F.lit(as_of).cast("timestamp_ntz")) / F.lit(3600e6)
    return newest.withColumn("age_hours", age).withColumn("is_fresh", F.coalesce(F.col("age_hours") <= max_hours, F.lit(False)))


def source_freshness(
    df: DataFrame, as_of: str, column: str = "ingested_at", warn: float = V.SOURCE_WARN_HOURS, error: float = V.SOURCE_ERROR_HOURS
) -> DataFrame:
    aged = freshness(df, column, as_of, warn).drop("is_fresh")
    age = F.col("age_hours")
    return aged.withColumn("status", F.when(age <= warn, "pass").when(age <= error, "warn").otherwise("error"))


def completeness(
    df: DataFrame, columns: Sequence[str] = tuple(V.CRITICAL_COLUMNS), minimum: float = V.CRITICAL_COMPLETENESS
) -> DataFrame:
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(name)).alias(f"_{name}") for name in columns])
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"_{name}").alias("non_null_count"),
            (F.col(f"_{name}") / F.nullif(F.col("_rows"), F.lit(0))).alias("completeness"),
        )
        for name in columns
    ]
    return counted.select(F.inline(F.array(*entries))).withColumn(
        "is_complete", F.coalesce(F.col("completeness") >= minimum, F.lit(True))
    )


def payload_fields(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Field names found in JSON payloads and the number of records that carry each."""
    names = F.map_keys(F.from_json(F.col(payload), "map<string,string>"))
    return df.select(F.explode(names).alias("field")).groupBy("field").agg(F.count("*").alias("records"))


def schema_drift(fields: DataFrame, contract: Sequence[str]) -> DataFrame:
    """Compare found field names with a contract: 'known', 'unknown' or 'missing'."""
    expected = fields.sparkSession.range(1).select(F.explode(F.array(*[F.lit(name) for name in contract])).alias("expected"))
    joined = fields.join(expected, F.col("field") == F.col("expected"), "full")
    status = F.when(F.col("expected").isNull(), "unknown").when(F.col("field").isNull(), "missing").otherwise("known")
    return joined.select(
        F.coalesce("field", "expected").alias("field"), F.coalesce("records", F.lit(0)).alias("records"), status.alias("status")
    )


def schema_differences(actual: T.StructType, contract: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, 'missing' | 'unknown' | 'retyped', contract type, actual type) for every difference."""
    have = {field.name: field.dataType.simpleString() for field in actual.fields}
    want = {field.name: field.dataType.simpleString() for field in contract.fields}
    found = [(name, "missing", kind, None) for name, kind in want.items() if name not in have]
    found += [(name, "unknown", None, kind) for name, kind in have.items() if name not in want]
    found += [(name, "retyped", want[name], have[name]) for name in want if name in have and want[name] != have[name]]
    return found


def uncastable(df: DataFrame, casts: Mapping[str, Column]) -> DataFrame:
    """Per column, how many non-null texts do not convert to their contract type."""
    counted = df.agg(*[
        part
        for name, cast in casts.items()
        for part in (
            F.count(F.col(name)).alias(f"_n_{name}"),
            F.count_if(F.col(name).isNotNull() & cast.isNull()).alias(f"_bad_{name}"),
        )
    ])
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"_n_{name}").alias("values"), F.col(f"_bad_{name}").alias("uncastable"))
        for name in casts
    ]
    return counted.select(F.inline(F.array(*entries)))


def _exact_profile(df: DataFrame, name: str, text: Column) -> DataFrame:
    """The profile of one column, a row if ``df`` has any."""
    values = df.select(text.alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    measured = values.agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    return measured.where(F.col("row_count").isNotNull()).select(F.lit(name).alias("column_name"), "*")


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, minimum and maximum (as text) per column.

    The default counts distinct values approximately in one aggregate. ``exact`` counts every value of a column once, combined
    per task before the shuffle, so repeated values and nulls cost little. Each column is read on its own, so a task holds the
    distinct values of one column only; ``df`` should be a stored table.
    """
    names = list(columns or df.columns)
    text = {name: F.col(name).cast("string") for name in names}
    if exact:
        return reduce(DataFrame.unionByName, [_exact_profile(df, name, text[name]) for name in names])
    measured = df.agg(F.count("*").alias("_rows"), *[
        F.struct(
            F.count_if(F.col(name).isNull()).alias("nulls"), F.approx_count_distinct(text[name]).alias("distinct"),
            F.min(text[name]).alias("low"), F.max(text[name]).alias("high"),
        ).alias(f"_{name}")
        for name in names
    ])
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"_{name}.nulls").alias("null_count"),
            F.col(f"_{name}.distinct").alias("distinct_count"), F.col(f"_{name}.low").alias("min_value"),
            F.col(f"_{name}.high").alias("max_value"),
        )
        for name in names
    ]
    return measured.select(F.inline(F.array(*entries)))


def status_changes(
    versions: DataFrame, key: str = "unique_key", moment: str = "ingested_at", tie: str = "source_row", status: str = "status"
) -> DataFrame:
    """Consecutive versions of one request whose status changed, with the verdict."""
    distinct = versions.where(F.col(key).isNotNull()).groupBy(key, moment, tie, status).agg(F.count("*").alias("_same"))
    order = [F.asc_nulls_first(moment), F.asc_nulls_first(tie), F.asc_nulls_first(status)]
    pairs = consecutive_pairs(distinct, key, order, [moment, tie, status])
    before, after = F.col(f"previous_{status}"), F.col(status)
    legal = [F.struct(F.lit(a), F.lit(b)) for a, b in V.STATUS_CHANGES]
    changed = pairs.where(~before.eqNullSafe(after))
    return changed.select(
        key, moment, tie, before.alias("from_status"), after.alias("to_status"),
        F.coalesce(F.struct(before, after).isin(*legal), F.lit(False)).alias("is_legal"),
    )


def illegal_status_changes(changes: DataFrame) -> DataFrame:
    return changes.groupBy("from_status", "to_status", "is_legal").agg(F.count("*").alias("changes"))


def merged_status_changes(changes: DataFrame, status: str = "status") -> DataFrame:
    """Status changes of a merge: the stored version against the incoming one, from the change feed of the table.

    Only replaced rows are looked at, once; versions that were never stored are not judged.
    """
    before, after = F.col(f"before.{status}"), F.col(f"after.{status}")
    legal = [F.struct(F.lit(a), F.lit(b)) for a, b in V.STATUS_CHANGES]
    pairs = changes.where(F.col("change") == "update").select("merge", before.alias("from_status"), after.alias("to_status"))
    changed = pairs.where(~F.col("from_status").eqNullSafe(F.col("to_status")))
    verdict = F.coalesce(F.struct("from_status", "to_status").isin(*legal), F.lit(False)).alias("is_legal")
    return changed.groupBy("merge", "from_status", "to_status", verdict).agg(F.count("*").alias("changes"))
