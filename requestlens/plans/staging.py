"""Staged requests: typed, trimmed and standardised, one row per accepted raw row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens.functions import standardize as S
from requestlens.functions.temporal import parse_datetime
from requestlens.sources.landing import conform


def staged_requests(raw: DataFrame, map_long_names: bool = False, strict_zip: bool = False) -> DataFrame:
    """Projection of the raw table; the options swap in the stricter agency and ZIP rules."""
    c = F.col
    rows = conform(raw).where(c("unique_key").isNotNull())

    def trimmed(*names: str) -> list[Column]:
        return [F.expr(f"trim({name}) AS {name}") for name in names]

    return rows.select(
        "unique_key",
        parse_datetime(c("created_date")).alias("created_at"),
        parse_datetime(F.nullif(F.trim("closed_date"), F.lit(""))).alias("closed_at"),
        parse_datetime(c("resolution_action_updated_date")).alias("resolution_updated_at"),
        (S.agency(c("agency")) if map_long_names else S.upper_trim(c("agency"))).alias("agency_code"),
        *trimmed("agency_name", "complaint_type", "descriptor"),
        S.upper_trim(c("location_type")).alias("location_type"),
        (S.zip_code(c("incident_zip")) if strict_zip else S.zip_digits(c("incident_zip"))).alias("incident_zip"),
        *trimmed("incident_address", "street_name", "cross_street_1", "cross_street_2"),
        S.upper_trim(c("city")).alias("city"),
        S.borough(c("borough")).alias("borough"),
        c("latitude").try_cast("double").alias("latitude"),
        c("longitude").try_cast("double").alias("longitude"),
        c("location").alias("location_json"),
        *trimmed(
            "status", "resolution_description", "community_board", "council_district", "census_tract", "bin", "bbl", "nta"
        ),
        "ingested_at",
        "batch_id",
        "raw_payload",
    )


def transformed_records(raw: DataFrame, policies: DataFrame, as_of: str) -> DataFrame:
    """The record-level transform: strict rules, the ordered policy list and the keyword taxonomy."""
    from requestlens.functions import rules as R
    from requestlens.functions import temporal as D
    from requestlens.operators.policies import with_first_policy

    c = F.col
    rows = conform(raw).select(
        "*",
        S.agency(c("agency")).alias("_agency"),
        D.parse_datetime(c("created_date")).alias("created_date_parsed"),
        D.parse_datetime(c("closed_date")).alias("closed_date_parsed"),
        S.location(c("location")).alias("_place"),
    )
    rows = with_first_policy(rows, policies, "_agency")
    created, closed = c("created_date_parsed"), c("closed_date_parsed")
    return rows.select(
        "unique_key",
        S.borough(c("borough"), any_space=True).alias("borough"),
        c("_agency").alias("agency"),
        S.zip_code(c("incident_zip")).alias("incident_zip"),
        "created_date_parsed",
        "closed_date_parsed",
        D.resolution_days(created, closed, strict=True).alias("resolution_days"),
        "sla_days",
        D.sla_compliant(created, closed, c("sla_days"), strict=True).alias("sla_compliant"),
        R.keyword_category(c("complaint_type"), c("descriptor")).alias("complaint_category"),
        F.lower(F.coalesce("complaint_type", F.lit(""))).alias("complaint_subcategory"),
        c("_place.type").alias("location_type_parsed"),
        c("_place.coordinates").alias("location_coordinates"),
        (c("latitude").isNotNull() & c("longitude").isNotNull()).alias("has_coordinates"),
        D.open_age_days(c("status"), created, F.lit(as_of).cast("timestamp_ntz")).alias("open_request_age_days"),
    )
