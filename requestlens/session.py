"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER_KEY = "requestlens.shared.folder"


def build_session(app_name: str = "requestlens", master: str | None = None, **overrides: str) -> SparkSession:
    """Session with the settings every plan here assumes; a cluster's own master and memory settings stay untouched."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Generated methods beyond 8,000 bytecodes are never compiled by the JVM; smaller ones run much faster.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(overrides)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local session that has none; on a cluster its absence is an error,
    because tables written to one machine's disk would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.conf.get(_FOLDER_KEY, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="requestlens-")
        spark.conf.set(_FOLDER_KEY, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/requestlens/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str, compression: str | None = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where several branches read one expensive input, or where a small result should be joined with its true
    size known: file statistics let Spark broadcast it below the threshold and shuffle it above.
    Tables are written once and read a few times, so they are worth a closer ``compression`` than that of the session.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
