"""Connected components of an edge table: rounds of contraction in Spark until the rest fits one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.session import store

# Edges that one task may hold: 32 MB of numbers.
EDGES_OF_A_TASK = 2_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node joined with each) of edges held in memory."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        apart = low != high
        if not apart.any():
            return nodes, nodes[parent]
        np.minimum.at(parent, high[apart], low[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if held:
        a, b = (np.concatenate([batch[name].to_numpy() for batch in held]) for name in ("a", "b"))
        nodes, component = roots(a, b)
        for at in range(0, len(nodes), 1 << 16):
            yield pa.RecordBatch.from_pydict({"node": nodes[at: at + (1 << 16)], "component": component[at: at + (1 << 16)]})


def connected_components(edges: DataFrame, most: int = EDGES_OF_A_TASK) -> DataFrame:
    """(node, component) for every node of the edges (a, b), nodes being of type long; ``component`` is some node of the component.

    Edges beyond ``most``, the number that one task may hold, are contracted first. Each round maps a node to the one of
    smallest hash among itself and its neighbours, and replaces both ends of every edge by where they map to. Every
    node but the local minima leaves the graph, so it shrinks by a constant factor at least, and a star is done in two rounds.
    All rounds are joins on nodes; a node with many edges is one row on the side of the maps. The edges that are left are
    joined in one task, and the maps of the rounds are applied one after the other. The result does not depend on ``most``
    but for which node stands for a component.
    """
    left = store(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "edges")
    nodes, maps = left, []
    while left.count() > most:
        both = left.union(left.select("b", "a"))
        order = F.struct(F.xxhash64("b"), "b")
        best = both.groupBy("a").agg(F.min(order).alias("m")).select(F.col("a").alias("node"), F.when(F.struct(F.xxhash64("a"), F.col("a")) < F.col("m"), F.col("a")).otherwise(F.col("m")["b"]).alias("to"))
        best = store(best, "maps")
        maps.append(best)
        left = store(
            left.join(best.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(best.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    last = store(left.coalesce(1).mapInArrow(_joined, "node long, component long"), "components")
    if not maps:
        return last
    found = nodes.select(F.col("a").alias("node")).union(nodes.select("b")).distinct().withColumn("component", F.col("node"))
    for best in [*maps, last.select("node", F.col("component").alias("to"))]:
        step = best.select(F.col("node").alias("component"), "to")
        found = found.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return found
