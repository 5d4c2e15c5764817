"""Matching requests to service-level policies."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens import fixed_values as V

ANY = "*"


def _best_per(policies: DataFrame, condition: Column, keys: list[str], name: str) -> DataFrame:
    """Days of the earliest policy per key combination, with the keys renamed out of the way."""
    days = F.min_by("sla_days", "policy_no").alias(name)
    first = F.min("policy_no").alias(f"{name}_no")
    found = policies.where(condition).groupBy(*keys).agg(days, first)
    return found.select(*[F.col(key).alias(f"{name}_{key}") for key in keys], name, f"{name}_no")


def _attach(df: DataFrame, level: DataFrame, match: dict[str, str], name: str) -> DataFrame:
    """Left join by plain equality; each level has one row per key, so no request row is multiplied."""
    condition = reduce(and_, [F.col(column) == F.col(f"{name}_{key}") for key, column in match.items()])
    return df.join(level, condition, "left").drop(*[f"{name}_{key}" for key in match])


def with_best_policy(
    df: DataFrame, policies: DataFrame, agency: str = "agency_code", complaint_type: str = "complaint_type",
    descriptor: str = "descriptor", default: int = V.DEFAULT_SLA_DAYS, name: str = "sla_days",
) -> DataFrame:
    """Days of the most specific policy: named type before ``*``, named descriptor before any, then list order.

    Each level of specificity is its own equality join. A level without policies is empty at planning time and
    drops out; a small one is broadcast by its known size, and a large policy table is shuffled like any join.
    """
    columns = {"agency": agency, "complaint_type": complaint_type, "descriptor": descriptor}
    named_type = F.col("complaint_type") != ANY
    any_descriptor = F.coalesce(F.col("descriptor"), F.lit(ANY)) == ANY
    levels = [
        (named_type & ~any_descriptor, ["agency", "complaint_type", "descriptor"]),
        (named_type & any_descriptor, ["agency", "complaint_type"]),
        (~named_type & ~any_descriptor, ["agency", "descriptor"]),
        (~named_type & any_descriptor, ["agency"]),
    ]
    concrete = policies.where(F.col("agency") != ANY)
    found, joined = [], df
    for number, (condition, keys) in enumerate(levels):
        level = f"_policy{number}"
        found.append(level)
        joined = _attach(joined, _best_per(concrete, condition, keys, level), {k: columns[k] for k in keys}, level)
    days = F.coalesce(*[F.col(level) for level in found], F.lit(default)).cast("int")
    return joined.withColumn(name, days).drop(*found, *[f"{level}_no" for level in found])


def with_all_policies(
    df: DataFrame, policies: DataFrame, agency: str = "agency_code", complaint_type: str = "complaint_type",
    descriptor: str = "descriptor", default: int = V.DEFAULT_SLA_DAYS, name: str = "sla_days",
) -> DataFrame:
    """Every matching policy, one output row each; the agency equality keeps this a hash join."""
    p = policies.select(*[F.col(column).alias(f"_p_{column}") for column in ("agency", "complaint_type", "descriptor", "sla_days")])
    condition = (
        (F.col("_p_agency") == F.col(agency))
        & ((F.col("_p_complaint_type") == F.col(complaint_type)) | (F.col("_p_complaint_type") == ANY))
        & (F.col("_p_descriptor").isNull() | (F.col("_p_descriptor") == F.col(descriptor)) | (F.col("_p_descriptor") == ANY))
    )
    joined = df.join(p, condition, "left")
    return joined.withColumn(name, F.coalesce("_p_sla_days", F.lit(default)).cast("int")).drop(
        "_p_agency", "_p_complaint_type", "_p_descriptor", "_p_sla_days"
    )


def with_first_policy(
    df: DataFrame, policies: DataFrame, agency: str, complaint_type: str = "complaint_type",
    descriptor: str = "descriptor", default: int = V.DEFAULT_SLA_DAYS, name: str = "sla_days",
) -> DataFrame:
    """Days of the first policy in list order with equal agency and type whose descriptor is equal or open."""
    columns = {"agency": agency, "complaint_type": complaint_type, "descriptor": descriptor}
    concrete = policies.where((F.col("agency") != ANY) | (F.col("complaint_type") != ANY))
    named = _best_per(concrete, F.col("descriptor").isNotNull(), ["agency", "complaint_type", "descriptor"], "_named")
    open_ = _best_per(concrete, F.col("descriptor").isNull(), ["agency", "complaint_type"], "_open")
    joined = _attach(df, named, columns, "_named")
    joined = _attach(joined, open_, {k: columns[k] for k in ("agency", "complaint_type")}, "_open")
    named_first = F.coalesce(F.col("_named_no") < F.col("_open_no"), F.col("_named_no").isNotNull())
    days = F.when(named_first, F.col("_named")).otherwise(F.col("_open"))
    return joined.withColumn(name, F.coalesce(days, F.lit(default)).cast("int")).drop(
        "_named", "_named_no", "_open", "_open_no"
    )
