"""The request fact table and its layout on disk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.functions.numeric import surrogate_key
from requestlens.schemas import FACT_COLUMNS

MONTH = "created_month_key"


def join_agency(df: DataFrame, dim: DataFrame, columns: tuple[str, ...] = ("agency_key",)) -> DataFrame:
    picked = dim.select(F.col("agency_key").alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = df.join(picked, F.col("_key") == F.col("agency_code"), "left")
    return joined.drop("_key").withColumnsRenamed({f"_{c}": c for c in columns})


def join_borough(df: DataFrame, dim: DataFrame) -> DataFrame:
    picked = dim.select("borough_key")
    return df.join(picked, F.col("borough_key") == F.col("borough"), "left")


def join_complaint(df: DataFrame, dim: DataFrame, match: str = "exact") -> DataFrame:
    """'exact' is null-safe on the descriptor and gives one row; 'all' lets a missing descriptor match every one."""
    picked = dim.select(
        "complaint_type_key", F.col("complaint_type").alias("_type"), F.col("descriptor").alias("_detail")
    )
    detail = F.col("_detail").eqNullSafe(F.col("descriptor"))
    if match == "all":
        detail = detail | F.col("_detail").isNull() | F.col("descriptor").isNull()
    return df.join(picked, (F.col("_type") == F.col("complaint_type")) & detail, "left").drop("_type", "_detail")


def complaint_matches(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows the 'all' match would give per complaint type, counted without making them.

    Requests are first counted per (type, descriptor); each such group meets the per-type number of dimension rows
    and the number with its own descriptor, so nothing larger than the dimension is joined.
    """
    groups = df.groupBy("complaint_type", "descriptor").agg(F.count("*").alias("requests"))
    per_type = dim.groupBy(F.col("complaint_type").alias("_type")).agg(
        F.count("*").alias("_rows"), F.count_if(F.col("descriptor").isNull()).alias("_open")
    )
    per_pair = dim.where(F.col("descriptor").isNotNull()).groupBy(
        F.col("complaint_type").alias("_pair_type"), F.col("descriptor").alias("_pair_detail")
    ).agg(F.count("*").alias("_same"))
    joined = groups.join(per_type, F.col("_type") == F.col("complaint_type"), "left").join(
        per_pair,
        (F.col("_pair_type") == F.col("complaint_type")) & (F.col("_pair_detail") == F.col("descriptor")),
        "left",
    )
    some = F.coalesce("_same", F.lit(0)) + F.coalesce("_open", F.lit(0))
    matches = F.greatest(F.when(F.col("descriptor").isNull(), F.coalesce("_rows", F.lit(0))).otherwise(some), F.lit(1))
    return joined.groupBy("complaint_type").agg(
        F.sum("requests").alias("requests"), F.sum(F.col("requests") * matches).alias("joined_rows")
    )


def build_fact(enriched: DataFrame, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The fact's 26 columns.

    ``dims`` maps 'agency', 'complaint_type' and 'borough' to dimension tables to join. Without it the keys are
    computed in place, which gives the same rows when the dimensions come from these very requests and saves the
    three joins.
    """
    rows = enriched.where(F.col("unique_key").isNotNull())
    if dims is None:
        kind = F.col("complaint_type")
        rows = rows.withColumns({
            "agency_key": F.col("agency_code"),
            "complaint_type_key": F.when(kind.isNotNull(), surrogate_key(kind, F.col("descriptor"))),
            "borough_key": F.col("borough"),
        })
    else:
        rows = join_agency(rows, dims["agency"])
        rows = join_complaint(rows, dims["complaint_type"])
        rows = join_borough(rows, dims["borough"])
    return rows.withColumnRenamed("unique_key", "request_key").select(*FACT_COLUMNS)


def by_month(rows: DataFrame, created: str = "created_at") -> DataFrame:
    """Rows dealt to tasks by created month, for ``write_fact`` with ``placed``.

    The rebalance splits a month that holds far more than its share over several tasks and files, where a plain
    repartition by month would give it to one task.
    """
    return rows.withColumn("_month", F.trunc(created, "MONTH")).hint("rebalance", "_month").drop("_month")


def write_fact(fact: DataFrame, path: str, only_months_present: bool = False, placed: bool = False) -> None:
    """Partition by created month, clustered by agency and borough inside each file.

    The whole table is replaced, or only the months that ``fact`` contains. ``placed`` says that the rows lie by month
    already: dealt before the fact's columns are derived from them, they are much narrower on their way.
    """
    rows = fact if placed else by_month(fact, "created_date_key")
    (
        rows.withColumn(MONTH, F.trunc("created_date_key", "MONTH"))
        .sortWithinPartitions(MONTH, "agency_key", "borough_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_months_present else "static")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_fact(spark, path: str, first_month: str | None = None, last_month: str | None = None) -> DataFrame:
    """The stored fact; month bounds prune folders before any file is opened."""
    rows = spark.read.parquet(path)
    if first_month:
        rows = rows.where(F.col(MONTH) >= F.lit(first_month).cast("date"))
    if last_month:
        rows = rows.where(F.col(MONTH) <= F.lit(last_month).cast("date"))
    return rows
