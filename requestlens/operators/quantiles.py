"""Exact interpolated quantiles per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestlens.session import store

# Rows of one bucket that a single task may rank; larger buckets are divided until they fit or hold one value.
LARGEST_BUCKET = 5_000_000
DIVIDE_BY = 4096
_RANKS = ["_low", "_high", "_share"]


def join_on_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two results grouped by the same keys; null keys meet. Keeps the left copy of the keys."""
    renamed = right.select(*[F.col(key).alias(f"_{key}") for key in keys], *[c for c in right.columns if c not in keys])
    match = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return left.join(renamed, match, how).drop(*[f"_{key}" for key in keys])


def _holding_ranks(histogram: DataFrame, keys: Sequence[str], before: Column) -> DataFrame:
    """The buckets that contain the lower or the upper wanted rank, with the number of rows before each."""
    running = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.withColumn("_upto", before + F.sum("_n").over(running))
    placed = placed.withColumn("_before", F.col("_upto") - F.col("_n"))
    found = placed.where((F.col("_before") <= F.col("_high")) & (F.col("_upto") > F.col("_low")))
    return found.select(*keys, "_bucket", "_before", "_n", "_least", "_most", *_RANKS)


def _counts() -> list[Column]:
    return [F.sum("_weight").alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most")]


def _locate(rows: DataFrame, keys: Sequence[str], quantile: float, width: float) -> DataFrame:
    histogram = rows.groupBy(*keys, F.floor(F.col("_value") / F.lit(width)).alias("_bucket")).agg(*_counts())
    position = (F.sum("_n").over(Window.partitionBy(*keys)) - 1) * F.lit(float(quantile))
    histogram = histogram.withColumn("_position", position).select(
        *keys, "_bucket", "_n", "_least", "_most", F.floor("_position").alias("_low"), F.ceil("_position").alias("_high"),
        (F.col("_position") - F.floor("_position")).alias("_share"),
    )
    return _holding_ranks(histogram, keys, F.lit(0))


def _rows_in(rows: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose value lies within one of the spans of their group. Spans of a group do not overlap."""
    renamed = spans.select(*[F.col(key).alias(f"_{key}") for key in keys], *[c for c in spans.columns if c not in [*keys, "_n"]])
    match = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return rows.join(renamed, match & F.col("_value").between(F.col("_least"), F.col("_most"))).drop(*[f"_{key}" for key in keys])


def grouped_quantile(
    df: DataFrame, by: Sequence[str], value: str, name: str, quantile: float = 0.5, width: float = 1.0,
    largest_bucket: int = LARGEST_BUCKET, weight: str | None = None,
) -> DataFrame:
    """Continuous quantile of the non-null ``value`` per group, exact, for at least one grouping column.

    A histogram of ``width``-wide buckets locates the one or two buckets that hold the wanted ranks. As long as such a
    bucket holds more than ``largest_bucket`` rows and several values, the range of its values is divided. Only the rows
    of the final buckets are counted by value and ranked. So no task ever holds the values of a whole group, unlike the
    built-in percentile, which merges all values of a group into one map. ``df`` is read at least twice, so it should be
    a stored table; the buckets found are stored so that the join back is planned by their true size. With ``weight``, a
    row stands for that many equal values, so that stored histograms can be merged.
    """
    keys = list(by)
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"), times.alias("_weight"))
    spans = store(_locate(rows, keys, quantile, width), "quantile-buckets")
    large = (F.col("_n") > largest_bucket) & (F.col("_least") < F.col("_most"))
    while not spans.where(large).isEmpty():
        # The least and the greatest value fall into different parts, so every round splits every large bucket.
        inside = _rows_in(rows, spans.where(large), keys).withColumnRenamed("_bucket", "_outer")
        share = (F.col("_value") - F.col("_least")) / (F.col("_most") - F.col("_least"))
        part = F.floor(share * F.lit(DIVIDE_BY)).alias("_bucket")
        finer = inside.select(*keys, "_outer", "_before", *_RANKS, part, "_value", "_weight").groupBy(*keys, "_outer", "_before", *_RANKS, "_bucket").agg(*_counts())
        finer = _holding_ranks(finer, [*keys, "_outer"], F.col("_before")).drop("_outer")
        spans = store(spans.where(~large).unionByName(finer), "quantile-buckets")
    found = _rows_in(rows, spans, keys)
    counted = found.groupBy(*keys, "_least", "_before", *_RANKS, "_value").agg(F.sum("_weight").alias("_n"))
    within = Window.partitionBy(*keys, "_least").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_end", F.col("_before") + F.sum("_n").over(within))
    start = F.col("_end") - F.col("_n")

    def at(rank: str) -> Column:
        return F.max(F.when((start <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col("_value")))

    picked = ranked.groupBy(*keys).agg(
        at("_low").alias("_at_low"), at("_high").alias("_at_high"), F.max("_share").alias("_share")
    )
    between = F.col("_at_low") + (F.col("_at_high") - F.col("_at_low")) * F.col("_share")
    return picked.select(*keys, between.alias(name))


def aggregate_with_quantile(
    df: DataFrame, by: Sequence[str], columns: Sequence[Column], value: str, name: str, quantile: float = 0.5
) -> DataFrame:
    """Grouped aggregates plus one exact quantile; groups without values get null. ``df`` should be a stored table."""
    keys = list(by)
    aggregated = df.groupBy(*keys).agg(*columns)
    if keys:
        return join_on_group(aggregated, grouped_quantile(df, keys, value, name, quantile), keys)
    whole = grouped_quantile(df.withColumn("_everything", F.lit(0)), ["_everything"], value, name, quantile)
    return aggregated.withColumn(name, whole.select(name).scalar())
