"""Global row positions without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestlens.session import store

_LOCAL_BITS = 33  # monotonically_increasing_id: task number above, position within the task below


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Number the rows 0.. in the given total order.

    Rows are range-partitioned and sorted, written once so that positions stay fixed even if a task is lost, and
    each task's rows are shifted by the sizes of the tasks before it. The only single-task step sees one row per task.
    """
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    stored = store(placed, "row-index").withColumn("_task", F.shiftright("_at", _LOCAL_BITS))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored.groupBy("_task").agg(F.count("*").alias("_size")).select(
        "_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    shifts = store(shifts, "row-index-shifts")
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return stored.join(shifts, "_task").withColumn(name, F.col("_shift") + local).drop("_at", "_task", "_shift")


def page_counts(df: DataFrame, order: Sequence[Column], page_size: int, created: str = "created_at") -> DataFrame:
    """Every page of the ordered set with its size and time span."""
    numbered = with_row_index(df, order)
    page = F.floor(F.col("row_index") / F.lit(page_size)).alias("page")
    return numbered.groupBy(page).agg(
        F.count("*").alias("rows"), F.min(created).alias("first_created"), F.max(created).alias("last_created")
    )


def fetch_page(df: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """One page of the ordered set, in order: a range of row positions, of which only the page itself is sorted again."""
    numbered = with_row_index(df, order, "_row")
    return numbered.where((F.col("_row") >= offset) & (F.col("_row") < offset + limit)).orderBy("_row").drop("_row")


def consecutive_pairs(df: DataFrame, key: str, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Each row beside its predecessor under the same key, as ``previous_<column>``.

    Neighbours are met by position, a unique join key, so one busy key never lands in one task.
    """
    numbered = with_row_index(df.select(key, *columns), [F.asc(key), *order])
    previous = numbered.select(
        (F.col("row_index") + 1).alias("row_index"),
        F.col(key).alias("_previous_key"),
        *[F.col(name).alias(f"previous_{name}") for name in columns],
    )
    pairs = numbered.join(previous, "row_index")
    return pairs.where(F.col(key).eqNullSafe(F.col("_previous_key"))).drop("row_index", "_previous_key")
