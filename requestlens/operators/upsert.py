"""Idempotent upsert by key, as a frame operation and on a month-partitioned parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from requestlens.functions.temporal import month_key, parse_datetime
from requestlens.operators.latest import latest_wins
from requestlens.session import store

MONTH = "created_month"
INSTANT = "created_at"


def upsert(
    target: DataFrame, batch: DataFrame, key: str = "unique_key", newest_first: Sequence[str] = ("ingested_at",),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Target after the batch: every column of a known key is replaced by its newest version."""
    return latest_wins(target.unionByName(batch, allowMissingColumns=True), key, newest_first, ties)


def upsert_counts(target: DataFrame, batch: DataFrame, key: str = "unique_key") -> DataFrame:
    """How many keys of the batch are new to the target and how many replace a row."""
    incoming = batch.groupBy(key).agg(F.count("*").alias("_rows"))
    known = target.select(F.col(key).alias("_known")).distinct()
    joined = incoming.join(known, F.col(key) == F.col("_known"), "left")
    return joined.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("records"),
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
    )


def with_month(df: DataFrame) -> DataFrame:
    """Adds the typed creation instant, on which range filters reach the files, and its month."""
    typed = df.withColumn(INSTANT, parse_datetime(F.col("created_date")))
    return typed.withColumn(MONTH, month_key(F.col(INSTANT)))


def write_months(df: DataFrame, path: str, placed: bool = False) -> list:
    """Replace the months present in ``df`` and return them. The rebalance keeps files even: a month with many rows is split.
    ``placed`` rows are written by the tasks that have them, without a shuffle, each in a file for every month of its rows.

    ``df`` may read the months that it replaces: Spark writes all files to a staging folder and puts them in the place
    of the old ones when every task is done. The months are observed on the way, so the rows need not be stored for a list of them.
    """
    seen = Observation()
    watched = df.observe(seen, F.collect_set(MONTH).alias("months"), F.max(F.col(MONTH).isNull()).alias("none"))
    (
        (watched if placed else watched.hint("rebalance", MONTH))
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", compression="zstd")
        .partitionBy(MONTH)
        .parquet(path)
    )
    found = seen.get
    return [*found["months"], *([None] if found["none"] else [])]


def _remove_months(df: DataFrame, path: str, months: Sequence) -> None:
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for month in months:
        folder = hadoop(f"{path}/{MONTH}={month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def upsert_table(
    batch: DataFrame, path: str, key: str = "unique_key", newest_first: Sequence[str] = ("ingested_at",),
    ties: Sequence[str] | None = None,
) -> None:
    """Upsert a batch of raw rows into the table at ``path``, rewriting only the months it touches.

    Touched are the months of the batch and those where its keys live now, found by a scan of key and month only.
    No file is replaced before all merged months are written, and a run that dies half-way gives the same table when it
    is repeated.
    """
    spark = batch.sparkSession
    incoming = store(latest_wins(with_month(batch), key, newest_first, ties), "upsert-batch")
    if not path_exists(spark, path):
        write_months(incoming, path)
        return
    target = spark.read.schema(incoming.schema).parquet(path)
    homes = target.select(key, MONTH).join(incoming.select(key), key, "left_semi").select(MONTH)
    # At most one value per calendar month: a short list that turns into static partition pruning.
    touched = [row[0] for row in incoming.select(MONTH).union(homes).distinct().collect()]
    merged = upsert(target.where(F.col(MONTH).isin(touched)), incoming, key, newest_first, ties)
    kept = write_months(merged, path)
    _remove_months(incoming, path, [month for month in touched if month not in kept])
