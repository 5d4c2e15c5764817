"""Contiguous shards of nearly equal bytes, from global prefix sums.

Rows are put in one global order by ranges. Each range adds up its sizes; the totals of the ranges, one row each, give every
range the sum of those before it. A row's global offset is that sum plus the running sum inside its range, so no task sees
more than one range. Equal cuts of the total then assign the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from requestlens.session import store

ROW_OVERHEAD = 8
COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def positions(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Adds ``_index`` (0-based place in the global order), ``_before`` (sizes of all rows before) and the totals ``_rows``, ``_sum``.

    ``order`` must be a total order, for instance by ending in a stored row number; then a value shared by a third of
    the rows is still spread over many ranges.
    """
    ranged = store(rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("_range", F.spark_partition_id()), "ranges")
    all_before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = ranged.groupBy("_range").agg(F.count("*").alias("_n"), F.sum(size).alias("_s")).select(
        "_range",
        F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_s").over(all_before), F.lit(0)).alias("_s_before"),
        F.sum("_n").over(everything).alias("_rows"),
        F.sum("_s").over(everything).alias("_sum"),
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_index", F.row_number().over(inside).cast("long") - 1)
        .withColumn("_before", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size))
        .join(totals, "_range")
        .withColumn("_index", F.col("_index") + F.col("_n_before"))
        .withColumn("_before", F.col("_before") + F.col("_s_before"))
        .drop("_range", "_n_before", "_s_before")
    )


def assign_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size: UTF-8 bytes of the text (null: none) plus 8. Law ``bytes``: the documents stand in one row by ascending doc_id (null
    last; repeated ids by checksum and size, equal rows in any order), as long as their sizes; the row is cut into
    ``n_shards`` equal lengths, and a document belongs to the cut that its middle lies in. Shards hence differ from the mean
    by at most half a document at either end. ``slot`` counts from 0 without gaps inside a shard. ``grown_shard`` belongs
    to laws by key and is always null. Equal texts may lie in different shards: a group of copies that holds a third of all
    bytes could not stay whole in shards of equal size. An empty table gives no rows; other columns are not read.
    """
    return _placed(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row")), n_shards).drop("_row")


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The documents themselves with their shards: the columns of ``assign_shards``, then those of ``docs``, text included.

    Rows are numbered in a stored copy, which the shards are joined to, so every copy of a repeated row has its own slot.
    A column of ``docs`` named like one of ``assign_shards`` is left out; doc_id is cast to long. An empty table gives no rows.
    """
    others = [c for c in docs.columns if c not in COLUMNS]
    numbered = store(
        docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), F.struct(F.lit(0).alias("_0"), *[docs[f"`{c}`"] for c in others]).alias("_others")),
        "numbered", "zstd",
    )
    # The copy holds the text once, among the other columns.
    placed = _placed(numbered.select("doc_id", F.col("_others.text").alias("text"), "_row"), n_shards)
    joined = placed.join(numbered.select("_row", "_others"), "_row")
    return joined.select(*COLUMNS, *[F.col(f"_others.`{c}`").alias(c) for c in others])


def _placed(rows: DataFrame, n_shards: int) -> DataFrame:
    """The columns of ``assign_shards`` and _row, for rows of doc_id, text and _row."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    narrow = store(
        rows.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
            "_row",
        ).withColumn("_null", F.col("doc_id").isNull()),
        "sizes",
    )
    placed = positions(narrow, ["_null", "doc_id", "text_crc32", "size", "_row"], "size")
    sharded = store(
        placed.select(
            "_row", "doc_id", "size", "text_crc32", "_index",
            F.least(F.lit(n_shards - 1), F.expr(f"(2 * _before + size) * {n_shards} div (2 * _sum)")).cast("int").alias("shard"),
        ),
        "shards",
    )
    firsts = sharded.groupBy("shard").agg(F.min("_index").alias("_first"))
    # At most n_shards rows.
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_index") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "_row",
    )
