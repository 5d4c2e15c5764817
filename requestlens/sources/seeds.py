"""Service-level policies as a small frame, from literals or from a CSV file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from requestlens import fixed_values as V
from requestlens.schemas import POLICY


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def policy_frame(spark: SparkSession, policies: Sequence[tuple] = V.SLA_POLICIES) -> DataFrame:
    """Policies as an inline table, whose exact size the optimizer knows; ``policy_no`` keeps the list order."""
    rows = ", ".join(
        "(" + ", ".join([str(number)] + [_literal(item) for item in policy]) + ")"
        for number, policy in enumerate(policies, start=1)
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} "
        "AS p(policy_no, agency, complaint_type, descriptor, sla_days, business_hours_only)"
    )


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """Policies from CSV files with a header and a column policy_no, which states their order; empty fields are null."""
    schema = T.StructType([T.StructField("policy_no", T.IntegerType()), *POLICY.fields])
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
