"""Pages of an ordered set that is stored once: a page opens only the slices that hold its rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a task
_SLICE, _AT = "slice", "_at"


class OrderedTable:
    """Rows in a total order, cut into slices of that order, and a small table of where each slice begins.

    ``<path>`` is partitioned by slice, and a row knows its place in its slice. ``<path>_bounds`` has one row per slice:
    its rows, the rows before it, its first and its last key. A page by position or by key picks slices from the bounds,
    so its cost does not depend on how far down it lies, and nothing is numbered or sorted again but the page.
    """

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str], schema: StructType | None = None) -> None:
        self.spark, self.path, self.order, self.schema = spark, path, list(order), schema

    @classmethod
    def write(cls, df: DataFrame, path: str, order: Sequence[str], slices: int | None = None) -> OrderedTable:
        """Store ``df`` by the ascending columns ``order``, nulls first, which together are unique."""
        keys = [F.asc_nulls_first(name) for name in order]
        ranged = df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)
        placed = ranged.sortWithinPartitions(*keys).select(
            *df.columns, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)).alias(_AT), F.spark_partition_id().alias(_SLICE)
        )
        placed.write.mode("errorifexists").partitionBy(_SLICE).parquet(path)
        table = cls(df.sparkSession, path, order, placed.schema)
        key = F.struct(*order)
        bounds = table._stored().groupBy(_SLICE).agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
        # One row per slice, so a window over all of them is small.
        before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        bounds.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}_bounds")
        return table

    def _stored(self) -> DataFrame:
        # Files of an empty set tell no columns.
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self.path)

    def bounds(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}_bounds")

    def _numbered(self, slices: Sequence, low: int = 0, high: int | None = None, name: str = "_row") -> DataFrame:
        """The rows of some slices, (slice, start) each, at positions from ``low`` on and before ``high``."""
        rows = self._stored()
        if not slices:
            return rows.where(F.lit(False)).withColumn(name, F.col(_AT)).drop(_SLICE, _AT)
        inside = [(F.col(_SLICE) == s) & (F.col(_AT) >= low - start) & (F.lit(True) if high is None else F.col(_AT) < high - start) for s, start in slices]
        start = reduce(lambda found, part: found.when(F.col(_SLICE) == part[0], part[1]), slices[1:], F.when(F.col(_SLICE) == slices[0][0], slices[0][1]))
        wanted = rows.where(F.col(_SLICE).isin([s for s, _ in slices])).where(reduce(or_, inside))
        return wanted.withColumn(name, (start + F.col(_AT)).cast("bigint")).drop(_SLICE, _AT)

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` - 1 of the order, in order."""
        end = offset + limit
        # Only slices that overlap the page: a few, unless the page is large itself.
        slices = self.bounds().where((F.col("start") < end) & (F.col("start") + F.col("rows") > offset)).orderBy(_SLICE).select(_SLICE, "start").collect()
        return self._numbered([tuple(row) for row in slices], offset, end).orderBy("_row").drop("_row")

    def page_after(self, key: Sequence[Column], limit: int) -> DataFrame:
        """The next ``limit`` rows after the given key, in order; the key need not occur."""
        after = F.struct(*[value.alias(name) for name, value in zip(self.order, key)])
        before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        # The first slice may have a single row left; those after it count whole.
        reach = self.bounds().where(F.col("last") > after).withColumn("_upto", F.sum("rows").over(before) - F.first("rows").over(Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, 0)))
        slices = reach.where(F.coalesce("_upto", F.lit(0)) < limit).orderBy(_SLICE).select(_SLICE, "start").collect()
        rows = self._numbered([tuple(row) for row in slices]).where(F.struct(*self.order) > after)
        return rows.orderBy("_row").limit(limit).drop("_row")

    def page_counts(self, page_size: int, created: str = "created_at") -> DataFrame:
        """Every page of the ordered set with its size and time span; the bounds give each row its position."""
        starts = self.bounds().select(_SLICE, "start")
        page = F.floor((F.col("start") + F.col(_AT)) / F.lit(page_size)).alias("page")
        return self._stored().select(_SLICE, _AT, created).join(starts, _SLICE).groupBy(page).agg(
            F.count("*").alias("rows"), F.min(created).alias("first_created"), F.max(created).alias("last_created")
        )
