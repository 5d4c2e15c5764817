"""Staged requests with service level, durations, category and calendar keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.functions import rules as R
from requestlens.functions import temporal as D
from requestlens.operators.policies import with_all_policies, with_best_policy


def enriched_requests(staged: DataFrame, policies: DataFrame, as_of: str, match: str = "best") -> DataFrame:
    """``match`` is 'best' (one policy per request) or 'all' (a row per matching policy)."""
    c = F.col
    moment = F.lit(as_of).cast("timestamp_ntz")
    with_policy = {"best": with_best_policy, "all": with_all_policies}[match]
    rows = with_policy(staged.where(c("unique_key").isNotNull()), policies)
    created, closed = c("created_at"), c("closed_at")
    return rows.select(
        *staged.columns,
        "sla_days",
        D.resolution_days(created, closed).alias("resolution_days"),
        D.sla_compliant(created, closed, c("sla_days")).alias("sla_compliant"),
        D.open_age_days(c("status"), created, moment).alias("open_request_age_days"),
        R.complaint_category(c("complaint_type")).alias("complaint_category"),
        D.day_key(created).alias("created_date_key"),
        D.day_key(closed).alias("closed_date_key"),
        D.week_key(created).alias("created_week_key"),
        D.month_key(created).alias("created_month_key"),
        R.is_emergency(c("complaint_type")).alias("is_emergency"),
        (c("latitude").isNotNull() & c("longitude").isNotNull()).alias("has_coordinates"),
        moment.alias("dbt_updated_at"),
    )
