"""Rounding, rates and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from requestlens import fixed_values as V


def rounded(value: Column, places: int = 2) -> Column:
    """Decimal rounding, half away from zero, so that 0.125 never depends on its binary form."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, null without a denominator."""
    return rounded(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), places)


def fraction(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def surrogate_key(*columns: Column) -> Column:
    parts = [F.coalesce(column.cast("string"), F.lit(V.SURROGATE_NULL)) for column in columns]
    return F.md5(F.concat_ws("-", *parts))
