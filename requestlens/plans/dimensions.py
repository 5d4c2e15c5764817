"""Dimension tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.functions import rules as R
from requestlens.functions import standardize as S
from requestlens.functions.numeric import surrogate_key


def _stamped(df: DataFrame, as_of: str | None) -> DataFrame:
    return df if as_of is None else df.withColumn("dbt_updated_at", F.lit(as_of).cast("timestamp_ntz"))


def dim_agency(requests: DataFrame, as_of: str | None = None, one_name: bool = True, weight: str | None = None) -> DataFrame:
    """One row per agency code under its most frequent name (lowest on ties); or every distinct pair.

    With ``weight``, a row stands for that many requests."""
    rows = requests.where(F.col("agency_code").isNotNull())
    if one_name:
        requests_of = F.count("*") if weight is None else F.sum(weight)
        counted = rows.groupBy("agency_code", "agency_name").agg(requests_of.alias("n"))
        # Smallest (no name, -count, name) struct = named before unnamed, then most frequent, then alphabetical.
        choice = F.min(F.struct(F.col("agency_name").isNull().alias("unnamed"), (-F.col("n")).alias("n"), "agency_name"))
        names = counted.groupBy("agency_code").agg(choice["agency_name"].alias("agency_name"))
    else:
        names = rows.select("agency_code", "agency_name").distinct()
    code = F.col("agency_code")
    return _stamped(names.select(code.alias("agency_key"), "agency_name", S.agency_domain(code).alias("agency_domain")), as_of)


def dim_borough(requests: DataFrame, as_of: str | None = None) -> DataFrame:
    name = F.col("borough")
    names = requests.select("borough").where(name.isNotNull()).distinct()
    return _stamped(
        names.select(
            name.alias("borough_key"), name.alias("borough_name"), S.county(name).alias("county_name"),
            S.borough_order(name).alias("borough_sort_order"),
        ),
        as_of,
    )


def dim_complaint_type(requests: DataFrame, as_of: str | None = None) -> DataFrame:
    kind, detail = F.col("complaint_type"), F.col("descriptor")
    pairs = requests.select("complaint_type", "descriptor").where(kind.isNotNull()).distinct()
    return _stamped(
        pairs.select(
            surrogate_key(kind, detail).alias("complaint_type_key"), "complaint_type", "descriptor",
            R.complaint_category(kind).alias("complaint_category"),
        ),
        as_of,
    )


def _holiday(day: Column) -> Column:
    return reduce(or_, [(F.month(day) == month) & (F.dayofmonth(day) == number) for month, number in V.FIXED_HOLIDAYS])


def date_attributes(days: DataFrame, day: str = "date_key", pad: bool = False) -> DataFrame:
    """Calendar attributes of a frame with one row per day; weekday 0 is Sunday; ``pad`` fills names to nine."""
    d = F.col(day)
    month_name, day_name = F.date_format(d, "MMMM"), F.date_format(d, "EEEE")
    if pad:
        month_name, day_name = F.rpad(month_name, 9, " "), F.rpad(day_name, 9, " ")
    weekday = F.dayofweek(d) - 1
    return days.select(
        d.alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name.alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        day_name.alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        _holiday(d).alias("is_federal_holiday"),
    )


def dim_date(
    spark: SparkSession, start: str = V.CALENDAR_START, end_exclusive: str = V.CALENDAR_END_EXCLUSIVE,
    as_of: str | None = None, pad: bool = False,
) -> DataFrame:
    days = spark.sql(
        "SELECT explode(sequence(CAST(:first AS DATE), date_sub(CAST(:past AS DATE), 1), INTERVAL 1 DAY)) AS date_key",
        args={"first": start, "past": end_exclusive},
    )
    return _stamped(date_attributes(days, pad=pad), as_of)


def dim_date_spanning(df: DataFrame, column: str, pad: bool = False) -> DataFrame:
    """The calendar from the first to the last day found in ``column``."""
    bounds = df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("date_key"))
    return date_attributes(days, pad=pad)
