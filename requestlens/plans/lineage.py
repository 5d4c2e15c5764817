"""Column lineage from landed model-metadata documents.

A document describes one model: ``{"name", "source", "transformations", "columns": {column: {"source_columns",
"transformations"}}}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens.session import store

DOCUMENT = (
    "name string, source string, transformations array<string>, "
    "columns map<string, struct<source_columns: array<string>, transformations: array<string>>>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).json(path)


def column_edges(documents: DataFrame) -> DataFrame:
    """(model, column, source_columns, transformations) for the columns that declare lineage."""
    entries = documents.select(F.col("name").alias("model"), F.explode("columns").alias("column", "info"))
    return entries.where(F.size("info.source_columns") > 0).select(
        "model", "column", F.col("info.source_columns").alias("source_columns"), F.col("info.transformations").alias("transformations")
    )


def column_lineage(edges: DataFrame, model: str, column: str) -> DataFrame:
    return edges.where((F.col("model") == model) & (F.col("column") == column)).select("source_columns", "transformations")


def report(edges: DataFrame) -> DataFrame:
    return edges.select(F.to_json(F.struct("model", "column", "source_columns", "transformations")).alias("entry"))


def model_edges(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("source").isNotNull()).select(F.col("name").alias("model"), "source", "transformations")


def _without_layer(name):
    """'layer.table.column' and 'table.column' both become 'table.column'."""
    return F.regexp_replace(name, r"^[^.]+\.([^.]+\.[^.]+)$", "$1")


def trace(edges: DataFrame, model: str, column: str) -> DataFrame:
    """All columns that ``model.column`` is built from, with the number of steps.

    Every round looks up the columns reached in the one before and not seen earlier, until there are none; so ancestors at
    any distance are found, and cycles end.
    """
    steps = edges.select(
        F.concat_ws(".", "model", "column").alias("target"), F.explode("source_columns").alias("source"), "transformations"
    ).select("target", F.col("source").alias("source_name"), _without_layer(F.col("source")).alias("source"), "transformations")
    steps = store(steps, "lineage-steps")
    reached = store(steps.where(F.col("target") == f"{model}.{column}").withColumn("depth", F.lit(1)), "lineage")
    depth = 1
    while True:
        seen = reached.select("target").distinct()
        ahead = reached.where(F.col("depth") == depth).select(F.col("source").alias("target")).distinct().join(seen, "target", "left_anti")
        found = store(steps.join(ahead, "target").withColumn("depth", F.lit(depth + 1)), "lineage")
        if found.isEmpty():
            break
        reached, depth = reached.unionByName(found), depth + 1
    return reached.groupBy("target", "source", "source_name", "transformations").agg(F.min("depth").alias("depth"))
