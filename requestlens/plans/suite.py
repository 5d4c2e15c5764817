"""Declarative expectation suites evaluated in one aggregate pass.

An expectation is a plain dict: ``{"expectation_type", "kwargs", "meta": {"dimension", "severity"}}``. Uniqueness is
the only rule that needs its own (key, count) aggregation; every other rule is a column of the same aggregate.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.functions.temporal import parse_datetime
from requestlens.operators.quantiles import join_on_group

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
TEXT_FORMAT = "expect_column_values_to_match_strftime_format"
ROW_COUNT = "expect_table_row_count_to_be_between"

_STRFTIME_PARTS = {
    "%Y": "[0-9]{4}", "%m": "[0-9]{1,2}", "%d": "[0-9]{1,2}", "%H": "[0-9]{1,2}",
    "%M": "[0-9]{1,2}", "%S": "[0-9]{1,2}", "%f": "[0-9]{1,6}",
}
_COLUMN_REFERENCE = re.compile(r"^\{\{\s*(\w+)\s*\}\}$")


def expectation(kind: str, dimension: str, severity: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": kwargs, "meta": {"dimension": dimension, "severity": severity}}


def request_suite() -> dict:
    """The 19 expectations on raw requests."""
    lat, lon, rows = V.LATITUDE_BOUNDS, V.LONGITUDE_BOUNDS, V.ROW_COUNT_BOUNDS
    expectations = [
        expectation(NOT_NULL, "completeness", "critical", column="unique_key"),
        expectation(UNIQUE, "uniqueness", "critical", column="unique_key"),
        expectation(NOT_NULL, "completeness", "critical", column="created_date"),
        expectation(TEXT_FORMAT, "format", "warning", column="created_date", strftime_format="%Y-%m-%dT%H:%M:%S.%f"),
        expectation(
            BETWEEN, "referential_integrity", "warning", column="closed_date", min_value="{{ created_date }}",
            parse_strings_as_datetimes=True,
        ),
        expectation(NOT_NULL, "completeness", "critical", column="agency"),
        expectation(IN_SET, "referential_integrity", "warning", column="agency", value_set=V.AGENCY_CODES),
        expectation(NOT_NULL, "completeness", "warning", column="agency_name"),
        expectation(NOT_NULL, "completeness", "critical", column="complaint_type"),
        expectation(NOT_NULL, "completeness", "warning", column="descriptor", mostly=0.9),
        expectation(IN_SET, "validity", "warning", column="location_type", value_set=V.LOCATION_TYPES),
        expectation(REGEX, "validity", "warning", column="incident_zip", regex=V.ZIP_PATTERN, mostly=0.85),
        expectation(NOT_NULL, "completeness", "critical", column="borough"),
        expectation(IN_SET, "referential_integrity", "critical", column="borough", value_set=V.BOROUGHS),
        expectation(BETWEEN, "validity", "warning", column="latitude", min_value=lat[0], max_value=lat[1], mostly=0.7),
        expectation(BETWEEN, "validity", "warning", column="longitude", min_value=lon[0], max_value=lon[1], mostly=0.7),
        expectation(IN_SET, "validity", "warning", column="status", value_set=V.STATUSES),
        expectation(NOT_NULL, "completeness", "info", column="resolution_description", mostly=0.8),
        expectation(ROW_COUNT, "volume", "warning", min_value=rows[0], max_value=rows[1]),
    ]
    return {
        "expectation_suite_name": "service_requests_suite",
        "expectations": expectations,
        "meta": {"version": "1.0", "description": "Service request validation suite"},
    }


def save_suite(suite: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as out:
        json.dump(suite, out, indent=2)


def load_suite(path: str) -> dict:
    with open(path, encoding="utf-8") as source:
        return json.load(source)


def _bound(value, as_time: bool) -> Column:
    reference = _COLUMN_REFERENCE.match(value) if isinstance(value, str) else None
    if reference:
        column = F.col(reference.group(1))
        return parse_datetime(column) if as_time else column
    return F.lit(value).cast("timestamp_ntz") if as_time else F.lit(value)


def _outside(kwargs: dict) -> Column:
    """True where a value lies outside its bounds; a text that is no number counts as outside.

    Bounds on another column compare only rows where both sides are known.
    """
    column = F.col(kwargs["column"])
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    if kwargs.get("parse_strings_as_datetimes"):
        value = parse_datetime(column)
        checks = [value < _bound(low, True)] if low is not None else []
        checks += [value > _bound(high, True)] if high is not None else []
    else:
        value = column.try_cast("double")
        checks = [column.isNotNull() & value.isNull()]
        checks += [value < _bound(low, False)] if low is not None else []
        checks += [value > _bound(high, False)] if high is not None else []
    result = F.coalesce(checks[0], F.lit(False))
    for check in checks[1:]:
        result = result | F.coalesce(check, F.lit(False))
    return result


def _format_pattern(layout: str) -> str:
    parts = re.split(r"(%[A-Za-z])", layout)
    return "^" + "".join(_STRFTIME_PARTS[part] if part in _STRFTIME_PARTS else re.escape(part) for part in parts) + r"\z"


def unexpected(rule: dict) -> Column:
    """Condition that holds for the rows a rule counts as unexpected."""
    kind, kwargs = rule["expectation_type"], rule["kwargs"]
    column = F.col(kwargs["column"])
    if kind == NOT_NULL:
        return column.isNull()
    if kind == IN_SET:
        return ~column.isin(*kwargs["value_set"])
    if kind == REGEX:
        return ~column.rlike(kwargs["regex"])
    if kind == BETWEEN:
        return _outside(kwargs)
    if kind == TEXT_FORMAT:
        fits = column.rlike(_format_pattern(kwargs["strftime_format"])) & parse_datetime(column).isNotNull()
        return column.isNotNull() & ~F.coalesce(fits, F.lit(False))
    raise ValueError(f"unknown expectation type {kind}")


def _flags(suite: dict) -> dict[str, Column]:
    """Per flag its condition: values that are missing, by column, and values a rule counts as unexpected, by number."""
    flags = {}
    for number, rule in enumerate(suite["expectations"], start=1):
        kind, column = rule["expectation_type"], rule["kwargs"].get("column")
        if column:
            flags[f"_null_{column}"] = F.col(column).isNull()
        if kind not in (NOT_NULL, UNIQUE, ROW_COUNT):
            flags[f"_wrong{number}"] = unexpected(rule)
    return flags


def _unique_columns(suite: dict) -> list[str]:
    return list(dict.fromkeys(rule["kwargs"]["column"] for rule in suite["expectations"] if rule["expectation_type"] == UNIQUE))


def flagged(df: DataFrame, suite: dict, by: Sequence[str] = ()) -> DataFrame:
    """All that ``evaluate_flagged`` reads of each row: groups, unique columns and flags.

    Both of its branches read the rows, so these are worth storing where ``df`` is costly; they are much narrower.
    """
    kept = list(dict.fromkeys([*by, *_unique_columns(suite)]))
    return df.select(*kept, *[flag.alias(name) for name, flag in _flags(suite).items()])


def _repeated_rows(df: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias(name))


def row_counts(df: DataFrame, suite: dict, groups: Sequence[str] = ()) -> DataFrame:
    """One aggregate with the rows, and per expectation the missing and unexpected values; uniqueness is not part of it."""
    return _counts(df, suite, groups, _flags(suite))


def _counts(df: DataFrame, suite: dict, groups: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    aggregates = [F.count("*").alias("_rows")]
    for number, rule in enumerate(suite["expectations"], start=1):
        kind, column = rule["expectation_type"], rule["kwargs"].get("column")
        if column:
            aggregates.append(F.count_if(flags[f"_null_{column}"]).alias(f"_missing{number}"))
        if kind not in (UNIQUE, ROW_COUNT):
            wrong = flags[f"_null_{column}" if kind == NOT_NULL else f"_wrong{number}"]
            aggregates.append(F.count_if(wrong).alias(f"_unexpected{number}"))
    return df.groupBy(*groups).agg(*aggregates)


def evaluate(df: DataFrame, suite: dict, by: Sequence[str] = ()) -> DataFrame:
    """One row per expectation (and per group of ``by``) with counts and the verdict."""
    return _evaluated(df, suite, list(by), _flags(suite))


def evaluate_flagged(rows: DataFrame, suite: dict, by: Sequence[str] = ()) -> DataFrame:
    """``evaluate`` on the rows of ``flagged`` with the same suite and groups."""
    return _evaluated(rows, suite, list(by), {name: F.col(name) for name in _flags(suite)})


def _evaluated(df: DataFrame, suite: dict, groups: list[str], flags: dict[str, Column]) -> DataFrame:
    metrics = _counts(df, suite, groups, flags)
    for number, rule in enumerate(suite["expectations"], start=1):
        if rule["expectation_type"] == UNIQUE:
            name = f"_unexpected{number}"
            repeated = _repeated_rows(df, rule["kwargs"]["column"], groups, name)
            if groups:
                metrics = join_on_group(metrics, repeated, groups).fillna({name: 0})
            else:
                metrics = metrics.withColumn(name, repeated.scalar())
    return verdicts(metrics, suite, groups)


def verdicts(metrics: DataFrame, suite: dict, groups: Sequence[str] = ()) -> DataFrame:
    """The results of a suite from its counts: those of ``row_counts``, and of the repeated rows of unique columns."""
    rules = list(enumerate(suite["expectations"], start=1))
    entries = []
    for number, rule in rules:
        kind, kwargs, meta = rule["expectation_type"], rule["kwargs"], rule.get("meta", {})
        rows, zero = F.col("_rows"), F.lit(0).cast("bigint")
        missing = F.col(f"_missing{number}") if "column" in kwargs else zero
        if kind == ROW_COUNT:
            wrong, population = zero, zero
            low, high = kwargs.get("min_value"), kwargs.get("max_value")
            passed = (rows >= (low if low is not None else 0)) & (F.lit(True) if high is None else rows <= high)
        else:
            wrong = F.col(f"_unexpected{number}")
            population = rows if kind == NOT_NULL else rows - missing
            passed = (population == 0) | ((population - wrong) / population >= F.lit(float(kwargs.get("mostly", 1.0))))
        entries.append(
            F.struct(
                F.lit(number).alias("expectation_no"),
                F.lit(kind).alias("expectation_type"),
                F.lit(kwargs.get("column")).cast("string").alias("column_name"),
                F.lit(meta.get("dimension")).cast("string").alias("dimension"),
                F.lit(meta.get("severity")).cast("string").alias("severity"),
                rows.alias("element_count"),
                missing.alias("missing_count"),
                wrong.alias("unexpected_count"),
                F.round(F.lit(100.0) * wrong / F.nullif(population, F.lit(0)), 6).alias("unexpected_percent"),
                (rows if kind == ROW_COUNT else F.lit(None).cast("bigint")).alias("observed_value"),
                F.coalesce(passed, F.lit(True)).alias("success"),
            )
        )
    return metrics.select(*groups, F.inline(F.array(*entries)))


def statistics(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return results.groupBy(*by).agg(
        F.count("*").alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
        F.every("success").alias("success"),
    )


def by_dimension(results: DataFrame) -> DataFrame:
    return statistics(results, ["dimension", "severity"])


def gate(results: DataFrame, blocking: Sequence[str] = ("critical",)) -> DataFrame:
    """One row: do all blocking expectations hold, and how many of each kind fail?"""
    blocks = F.col("severity").isin(*blocking)
    return results.agg(
        F.coalesce(F.every(F.when(blocks, F.col("success"))), F.lit(True)).alias("passed"),
        F.count_if(blocks & ~F.col("success")).alias("blocking_failures"),
        F.count_if(~blocks & ~F.col("success")).alias("other_failures"),
    )


def latest_batch(df: DataFrame, batch: str = "batch_id", newest: str | None = None) -> DataFrame:
    """Rows of the newest batch, by its name or by the column ``newest``; the name is a scalar subquery."""
    name = F.max_by(batch, newest) if newest else F.max(batch)
    return df.where(F.col(batch) == df.agg(name).scalar())


def checkpoint_run(
    df: DataFrame, suite: dict, run_id: str, batch: str = "batch_id", newest: str | None = None, whole: bool = False
) -> DataFrame:
    """The suite over the newest batch, with the run and batch identifiers; ``whole`` says that ``df`` is that batch."""
    rows = df if whole else latest_batch(df, batch, newest)
    return evaluate(rows, suite, [batch]).withColumn("run_id", F.lit(run_id))


def save_results(results: DataFrame, path: str) -> None:
    """Keep the results of a run; repeating a run replaces its own results only."""
    results.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
