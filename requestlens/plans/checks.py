"""Column tests on models and invariants of the fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens import fixed_values as V


def column_test(model: str, column: str, test: str, severity: str = "error", **args) -> dict:
    return {"model": model, "column": column, "test": test, "severity": severity, "args": args}


def request_model_tests() -> list[dict]:
    """The tests declared on the raw, staged, enriched, mart and fact models."""
    lat, lon = V.LATITUDE_BOUNDS, V.LONGITUDE_BOUNDS
    raw, stg, enr, fact = "raw_requests", "stg_requests", "int_requests_enriched", "fact_service_requests"
    daily, monthly, card = "int_daily_agency_metrics", "agg_monthly_borough_performance", "agg_agency_sla_scorecard"
    percent = {"min_value": 0, "max_value": 100}
    return [
        column_test(raw, "unique_key", "not_null"),
        column_test(raw, "unique_key", "unique"),
        column_test(raw, "created_date", "not_null"),
        column_test(raw, "agency", "not_null"),
        column_test(raw, "borough", "not_null"),
        column_test(raw, "borough", "accepted_values", values=V.BOROUGHS),
        column_test(stg, "unique_key", "not_null"),
        column_test(stg, "unique_key", "unique"),
        column_test(stg, "created_at", "not_null"),
        column_test(stg, "agency_code", "not_null"),
        column_test(stg, "agency_code", "accepted_values", values=V.AGENCY_CODES),
        column_test(stg, "complaint_type", "not_null"),
        column_test(stg, "borough", "not_null"),
        column_test(stg, "borough", "accepted_values", values=V.BOROUGHS),
        column_test(stg, "incident_zip", "matches", severity="warn", regex=V.ZIP_PATTERN),
        column_test(stg, "latitude", "between", severity="warn", min_value=lat[0], max_value=lat[1]),
        column_test(stg, "longitude", "between", severity="warn", min_value=lon[0], max_value=lon[1]),
        column_test(stg, "status", "accepted_values", values=V.STATUSES),
        column_test(enr, "unique_key", "not_null"),
        column_test(enr, "unique_key", "unique"),
        column_test(enr, "sla_days", "not_null"),
        column_test(enr, "sla_days", "between", min_value=1, max_value=365),
        column_test(enr, "complaint_category", "accepted_values", values=V.CATEGORIES),
        column_test(daily, "date_key", "not_null"),
        column_test(daily, "date_key", "relationships", to="dim_date", field="date_key"),
        column_test(daily, "sla_compliance_rate", "between", **percent),
        column_test(fact, "request_key", "not_null"),
        column_test(fact, "request_key", "unique"),
        column_test(fact, "created_date_key", "not_null"),
        column_test(fact, "created_date_key", "relationships", to="dim_date", field="date_key"),
        column_test(fact, "agency_key", "not_null"),
        column_test(fact, "agency_key", "relationships", to="dim_agency", field="agency_key"),
        column_test(fact, "complaint_type_key", "not_null"),
        column_test(fact, "complaint_type_key", "relationships", to="dim_complaint_type", field="complaint_type_key"),
        column_test(fact, "borough_key", "not_null"),
        column_test(fact, "borough_key", "relationships", to="dim_borough", field="borough_key"),
        column_test(monthly, "sla_compliance_rate_pct", "between", **percent),
        column_test(card, "sla_compliance_rate_pct", "between", **percent),
    ]


def _row_failure(test: dict) -> Column | None:
    column, args = F.col(test["column"]), test["args"]
    if test["test"] == "not_null":
        return column.isNull()
    if test["test"] == "accepted_values":
        return ~column.isin(*args["values"])
    if test["test"] == "matches":
        return ~column.rlike(args["regex"])
    if test["test"] == "between":
        return ~column.between(args["min_value"], args["max_value"])
    return None


def duplicate_keys(df: DataFrame, key: str, count: str = "cnt") -> DataFrame:
    """Key values that occur more than once."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def missing_references(df: DataFrame, column: str, dim: DataFrame, field: str) -> DataFrame:
    """Key values without a dimension row and how many rows carry them; rows are counted per key before the join."""
    carried = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return carried.join(dim.select(F.col(field).alias("_field")), F.col(column) == F.col("_field"), "left_anti")


def _entry(test: dict, failures: Column):
    return F.struct(
        F.lit(test["model"]).alias("model"), F.lit(test["column"]).alias("column_name"),
        F.lit(test["test"]).alias("test"), F.lit(test["severity"]).alias("severity"), failures.alias("failures"),
    )


def run_column_tests(tables: Mapping[str, DataFrame], tests: Sequence[dict]) -> DataFrame:
    """One row per test with its failure count and status. Row-level tests of a model share one aggregate."""
    results = []
    for model in dict.fromkeys(test["model"] for test in tests):
        own = [test for test in tests if test["model"] == model]
        simple = [(test, _row_failure(test)) for test in own if _row_failure(test) is not None]
        if simple:
            counted = tables[model].agg(*[F.count_if(failure).alias(f"_f{i}") for i, (_, failure) in enumerate(simple)])
            entries = [_entry(test, F.col(f"_f{i}")) for i, (test, _) in enumerate(simple)]
            results.append(counted.select(F.inline(F.array(*entries))))
        for test in own:
            if test["test"] == "unique":
                repeated = duplicate_keys(tables[model], test["column"]).agg(F.count("*").alias("_f"))
                results.append(repeated.select(F.inline(F.array(_entry(test, F.col("_f"))))))
            elif test["test"] == "relationships":
                args = test["args"]
                lost = missing_references(tables[model], test["column"], tables[args["to"]], args["field"])
                total = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_f"))
                results.append(total.select(F.inline(F.array(_entry(test, F.col("_f"))))))
    together = reduce(DataFrame.unionByName, results)
    return together.withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail"))
    )


def _outside_city(lat: Column, lon: Column) -> Column:
    return ~lat.between(*V.LATITUDE_BOUNDS) | ~lon.between(*V.LONGITUDE_BOUNDS)


def fact_invariants() -> dict[str, Column]:
    """Name -> condition of a violating fact row."""
    c = F.col
    return {
        "missing_agency": c("agency_key").isNull(),
        "missing_borough": c("borough_key").isNull(),
        "missing_complaint_type": c("complaint_type_key").isNull(),
        "missing_date": c("created_date_key").isNull(),
        "negative_resolution": c("resolution_days") < 0,
        "compliance_on_open_request": c("sla_compliant").isNotNull() & (c("status") != "Closed"),
        "emergency_without_one_day_sla": c("is_emergency") & (c("sla_days") != 1),
        "invalid_borough": ~c("borough").isin(*V.BOROUGHS),
        "invalid_status": ~c("status").isin(*V.STATUSES),
        "coordinates_out_of_bounds": c("has_coordinates") & _outside_city(c("latitude"), c("longitude")),
    }


def fact_checks(fact: DataFrame) -> DataFrame:
    """Violations per invariant from one aggregate, plus the number of duplicated keys."""
    rules = fact_invariants()
    counted = fact.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    counted = counted.withColumn("duplicate_keys", duplicate_keys(fact, "request_key").agg(F.count("*")).scalar())
    names = ["duplicate_keys", *rules]
    entries = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failures")) for name in names]
    listed = counted.select(F.inline(F.array(*entries)))
    return listed.withColumn("passed", F.col("failures") == 0)


def missing_keys(fact: DataFrame) -> DataFrame:
    """Missing dimension keys by kind."""
    rules = {name: rule for name, rule in fact_invariants().items() if name.startswith("missing_")}
    counted = fact.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    entries = [F.struct(F.lit(name).alias("test"), F.col(name).alias("failures")) for name in rules]
    return counted.select(F.inline(F.array(*entries)))


def violations(fact: DataFrame) -> DataFrame:
    """The violating rows themselves, one row per request and broken invariant."""
    broken = [F.when(rule, F.lit(name)) for name, rule in fact_invariants().items()]
    return fact.select("request_key", F.explode(F.array_compact(F.array(*broken))).alias("check_name"))
