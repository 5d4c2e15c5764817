"""Contracts of semi-structured payloads: the fields and types that records really have, against those declared.

Payloads are parsed to VARIANT, so nothing is assumed about them: unknown fields stay visible, and every value keeps
the type that it has in the payload, whatever the declared columns would make of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens.session import store

_TYPE = r"^[A-Z]+"


def _plain(kind: Column) -> Column:
    """A type without its size or parts: DECIMAL(4,2) is DECIMAL, ARRAY<BIGINT> is ARRAY."""
    return F.nullif(F.regexp_extract(kind, _TYPE, 0), F.lit(""))


def parsed(df: DataFrame, payload: str, by: Sequence[str]) -> DataFrame:
    """(by, payload, value): the payload as VARIANT, null where it cannot be read."""
    return df.select(*by, F.col(payload).alias("payload"), F.try_parse_json(payload).alias("value"))


def payload_schema(df: DataFrame, payload: str, by: Sequence[str]) -> DataFrame:
    """The common schema of the payloads of each group, as text."""
    return parsed(df, payload, by).groupBy(*by).agg(F.schema_of_variant_agg("value").alias("payload_schema"))


def _field_counts(df: DataFrame, payload: str, declared: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """(by, field, found_type, records, retyped, unreadable) from one parse of the payloads.

    A payload without fields is a row without a field, so every group is present; one that is no JSON counts as unreadable there.
    """
    spark = df.sparkSession
    rows = parsed(df, payload, by).select(
        *by, (F.col("payload").isNotNull() & F.col("value").isNull()).alias("_unreadable"), F.col("value").alias("_document")
    )
    each = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("_document").outer()))
    each = each.withColumn("value", F.when(F.col("key").isNotNull() & ~F.is_variant_null("value"), F.col("value")))
    own = _plain(F.schema_of_variant("value"))
    pairs = [F.lit(text) for pair in declared.items() for text in pair]
    wanted = F.element_at(F.create_map(*pairs), F.col("key")) if pairs else F.lit(None).cast("string")
    return each.groupBy(*by, F.col("key").alias("field")).agg(
        _plain(F.schema_of_variant_agg("value")).alias("found_type"),
        F.count("value").alias("records"),
        F.count_if(own != wanted).alias("retyped"),
        F.count_if("_unreadable").alias("unreadable"),
    )


def field_types(df: DataFrame, payload: str, declared: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """(by, field, found_type, records, retyped) of every field with a value other than JSON null.

    ``found_type`` is the common type of the values, VARIANT where they have none; ``retyped`` counts values whose own
    type is not the declared one. One record per value is aggregated in the tasks, so a group of any size reaches the shuffle
    with one row per field and task.
    """
    return _field_counts(df, payload, declared, by).where(F.col("records") > 0).drop("unreadable")


def contract_report(df: DataFrame, payload: str, declared: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """(by, field, declared_type, found_type, records, retyped, status) for every group of payloads.

    ``status`` is known, retyped (some value has another type), unknown (not declared), or missing (declared, and no record of the
    group has it). A group with payloads that are no JSON has a row without a field, of status unreadable. ``by`` has no nulls.
    The payloads are parsed once; the counts, one row per group and field, are stored.
    """
    counted = store(_field_counts(df, payload, declared, by), "contract-fields")
    found = counted.where(F.col("records") > 0).drop("unreadable")
    counts = counted.groupBy(*by).agg(F.sum("unreadable").alias("records"))
    fields = F.array(*[F.struct(F.lit(name).alias("field"), F.lit(kind).alias("declared_type")) for name, kind in declared.items()])
    expected = counts.select(*by, F.inline(fields))
    status = (
        F.when(F.col("declared_type").isNull(), "unknown").when(F.col("records").isNull(), "missing")
        .when(F.col("retyped") > 0, "retyped").otherwise("known")
    )
    report = expected.join(found, [*by, "field"], "full").select(
        *by, "field", "declared_type", "found_type", F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("retyped", F.lit(0)).alias("retyped"), status.alias("status"),
    )
    nothing = F.lit(None).cast("string")
    unreadable = counts.where(F.col("records") > 0).select(
        *by, nothing.alias("field"), nothing.alias("declared_type"), nothing.alias("found_type"), "records",
        F.lit(0).cast("bigint").alias("retyped"), F.lit("unreadable").alias("status"),
    )
    return report.unionByName(unreadable)
