"""Nearest neighbours by cosine: all queries against all vectors, as the product of blocks of a matrix.

Vectors travel in blocks: eight-bit codes with their errors, and the original components. A cell is a block of queries beside
some blocks of candidates. The product of their codes gives each cosine up to a proven error; pairs that may be among
a query's nearest are worked out again in double precision and merged into a heap of the best for each query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestlens.llm.inputs import small_batches
from requestlens.llm.vectors import finite
from requestlens.session import store

BLOCK_ROWS, BLOCK_BYTES = 8192, 1 << 22
QUERY_ROWS = 2048
CELL_ROWS = 1 << 16
_TILE = 1 << 21
_PAIRS = 1 << 16
# More than products and norms of some ten thousand components can be off in double precision.
_ROUNDING = 1e-9
_FIELDS = ["length", "ids", "nulls", "vectors", "codes", "scales", "errors"]
_PACKED = "length int, ids binary, nulls binary, vectors binary, codes binary, scales binary, errors binary"


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the rows of two arrays, summed from the first component to the last, as a plain loop does it."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, errors): scale * codes lies within ``errors`` of the unit vector."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    left = unit - codes * scale[:, None]
    return codes.astype(np.int8), scale, np.sqrt(np.einsum("ij,ij->i", left, left)) + _ROUNDING


def _places(groups: np.ndarray) -> np.ndarray:
    """The place of each entry in its run of equal values."""
    opens = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    return np.arange(len(groups)) - np.repeat(opens, np.diff(np.append(opens, len(groups))))


def _needed(ids: np.ndarray, nulls: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the ``k`` nearest of some query.

    Equal vectors are equally near, so only the smallest ids count: of each vector the k + 1 smallest ids, as one of them may be
    the query's own, and of each id k rows.
    """
    raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    same = np.unique(raw, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, nulls, same))
    same, ids, nulls = same[order], ids[order], nulls[order]
    fresh = np.concatenate([[True], (same[1:] != same[:-1]) | (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])])
    number = np.cumsum(fresh)
    first = np.concatenate([[True], same[1:] != same[:-1]])
    of_vector = number - np.repeat(number[first], np.diff(np.append(np.flatnonzero(first), len(same))))
    return order[(of_vector <= k) & (_places(number) < k)]


def _packed(ids: np.ndarray, nulls: np.ndarray, vectors: np.ndarray) -> tuple:
    codes, scales, errors = quantised(vectors.astype(np.float64))
    return (vectors.shape[1], *(part.tobytes() for part in (ids, nulls, vectors, codes, scales, errors)))


def _held(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, nulls, vectors) of a task's rows, in blocks of equally long vectors."""
    held: dict[int, list] = {}

    def block(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.concatenate(parts) for parts in zip(*held.pop(length)))

    for batch in batches:
        lists = batch["v"]
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        nulls = batch["vec_id"].is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        ids = batch["vec_id"].fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        lengths = np.diff(offsets)
        for length in np.unique(lengths).tolist():
            most = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * length)))
            mine = np.flatnonzero(lengths == length)
            for at in range(0, len(mine), most):
                some = mine[at: at + most]
                vectors = values[offsets[some][:, None] + np.arange(length)].astype(kind)
                held.setdefault(length, []).append((ids[some], nulls[some], vectors))
                if sum(len(part[0]) for part in held[length]) >= most:
                    yield block(length)
    for length in list(held):
        yield block(length)


def _candidate_blocks(rows: DataFrame, kind: str, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, nulls, vectors in _held(batches, kind):
            keep = _needed(ids, nulls, vectors, k)
            yield pa.RecordBatch.from_pylist([dict(zip(_FIELDS, _packed(ids[keep], nulls[keep], vectors[keep])))], _SCHEMA)

    return rows.mapInArrow(run, _PACKED)


def _query_blocks(rows: DataFrame, kind: str, blocks: int) -> DataFrame:
    """Distinct queries, dealt by their hash into blocks of about QUERY_ROWS."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (ids, nulls, vectors) in enumerate(_held(batches, kind)):
            fields = {"qb": key[0].as_py(), "part": part} | dict(zip(_FIELDS, _packed(ids, nulls, vectors)))
            yield pa.RecordBatch.from_pylist([fields], pa.schema([("qb", pa.int32()), ("part", pa.int32()), *_SCHEMA]))

    dealt = rows.distinct().withColumn("qb", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("qb").applyInArrow(run, f"qb int, part int, {_PACKED}")


_SCHEMA = pa.schema([("length", pa.int32()), *((name, pa.binary()) for name in _FIELDS[1:])])


class _Block:
    """A block as arrays."""

    def __init__(self, row: dict, prefix: str, kind: str) -> None:
        def part(name: str, dtype: str) -> np.ndarray:
            return np.frombuffer(row[prefix + name], dtype)

        length = row[prefix + "length"]
        self.ids, self.nulls = part("ids", "<i8"), part("nulls", "u1")
        self.vectors = part("vectors", kind).reshape(-1, length).astype(np.float64)
        # Products of eight-bit codes are exact in single precision as long as their sum stays below 2**24.
        self.codes = part("codes", "i1").reshape(-1, length).astype(np.float32 if length * 127 * 127 < 1 << 24 else np.float64)
        self.scales, self.errors = part("scales", "<f8"), part("errors", "<f8")
        self.norms = in_order(self.vectors, self.vectors)


class Nearest:
    """The nearest candidates so far of each query of a block, as heaps whose root is the farthest of them."""

    def __init__(self, queries: _Block, k: int) -> None:
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in queries.ids]
        self.floor = np.full(len(queries.ids), -np.inf)

    def add(self, candidates: _Block) -> None:
        if candidates.vectors.shape[1] != self.queries.vectors.shape[1]:
            return
        step = max(1, _TILE // max(1, len(candidates.ids)))
        for at in range(0, len(self.queries.ids), step):
            self._add_tile(at, min(at + step, len(self.queries.ids)), candidates)

    def _add_tile(self, low: int, high: int, c: _Block) -> None:
        q = self.queries
        near = (q.codes[low:high] @ c.codes.T).astype(np.float64)
        near *= q.scales[low:high, None]
        near *= c.scales[None, :]
        # |u w - u' w'| <= |u - u'| |w| + |u'| |w - w'|, with unit vectors u and w
        error = q.errors[low:high, None] + (1 + q.errors[low:high, None]) * c.errors[None, :]
        own = (q.ids[low:high, None] == c.ids[None, :]) & (q.nulls[low:high, None] == c.nulls[None, :])
        least = near - error
        least[own] = -np.inf
        bar = self.floor[low:high].copy()
        if least.shape[1] >= self.k:
            bar = np.maximum(bar, np.partition(least, least.shape[1] - self.k, axis=1)[:, least.shape[1] - self.k])
        near += error
        near[own] = -np.inf
        row, column = np.nonzero((near >= bar[:, None]) & ~own)
        row += low
        score = np.concatenate([np.empty(0), *(self._exact(row[i: i + _PAIRS], column[i: i + _PAIRS], c) for i in range(0, len(row), _PAIRS))])
        order = np.lexsort((c.ids[column], c.nulls[column], -score, row))
        best = order[_places(row[order]) < self.k] if len(order) else order
        for i in best.tolist():
            at, entry = int(row[i]), (float(score[i]), -int(c.nulls[column[i]]), -int(c.ids[column[i]]))
            heap = self.heaps[at]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[at] = heap[0][0] - _ROUNDING

    def _exact(self, row: np.ndarray, column: np.ndarray, c: _Block) -> np.ndarray:
        q = self.queries
        return in_order(q.vectors[row], c.vectors[column]) / np.sqrt(q.norms[row] * c.norms[column])

    def rows(self, block: int, part: int) -> pa.RecordBatch:
        found = [
            (block, part, at, int(self.queries.ids[at]), None if entry[1] else -entry[2], entry[0])
            for at, heap in enumerate(self.heaps) for entry in heap
        ]
        columns = zip(*found) if found else [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()))],
            ["qb", "part", "at", "query_id", "vec_id", "score"],
        )


def _cells(cells: DataFrame, kind: str, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one block of queries follow each other where Spark has sorted them; if not, a list is only split.
        key, nearest = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["qb"], row["part"]) != key:
                    if nearest:
                        yield nearest.rows(*key)
                    key, nearest = (row["qb"], row["part"]), Nearest(_Block(row, "q_", kind), k)
                nearest.add(_Block(row, "", kind))
        if nearest:
            yield nearest.rows(*key)

    return cells.mapInArrow(run, "qb int, part int, at int, query_id bigint, vec_id bigint, score double")


def _vectors(table: DataFrame, vec_id: str, vector: str, kind: str) -> DataFrame:
    """(vec_id, v) of the rows with a finite vector that is not nought.

    Vectors in double precision are scaled by powers of two, which changes no cosine but keeps squares from overflowing.
    """
    whole = F.col(vector).cast("array<double>")
    rows = table.where(finite(whole) & F.coalesce(F.exists(whole, lambda x: x != 0), F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    if kind == "double":
        power = F.floor(F.log2(F.array_max(F.transform("v", F.abs))))
        half = F.floor(power / 2)
        rows = rows.select("vec_id", F.transform("v", lambda x: x * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - power)).alias("v"))
    return rows


def nearest_neighbours(
    vectors: DataFrame, asked: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine for each row for which ``asked``, on the id, holds.

    The search is exact. ``rank`` counts from 1, nearest first, ties to the smaller id, rows without an id last. Cosines are in
    double precision, of the vectors as given. Rows whose vector is null, nought, empty or has a null or non-finite
    component take no part. A query's own are all rows with its id. Repeated rows are candidates each; as queries
    they are one, while an id with several vectors is a query for each of them. Rows without an id are no queries.
    Vectors meet those of their own length only. Empty tables give an empty result; other columns are not read.

    Every block of queries meets every block of candidates in a cell, dealt by both numbers: queries travel once for
    each CELL_ROWS candidates, candidates once for each QUERY_ROWS queries.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kind = "float" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "double"
    dtype = "<f4" if kind == "float" else "<f8"
    rows = _vectors(vectors, vec_id, vector, kind)
    some = F.coalesce(asked, F.lit(False)) & F.col("vec_id").isNotNull()
    total = rows.agg(F.count("*").alias("rows"), F.count_if(some).alias("queries")).first()
    across = max(-(-total["rows"] // CELL_ROWS), spark.sparkContext.defaultParallelism)
    down = max(1, -(-total["queries"] // QUERY_ROWS))
    queries = store(_query_blocks(rows.where(some), dtype, down), "query-blocks").withColumnsRenamed({name: f"q_{name}" for name in _FIELDS})
    candidates = store(_candidate_blocks(rows, dtype, k), "candidate-blocks")
    candidates = candidates.withColumn("cell", F.pmod(F.xxhash64("ids", "codes"), F.lit(across)).cast("int"))
    cells = candidates.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).join(
        queries.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))), ["qb", "cell"]
    )
    found = _cells(cells, dtype, k)
    nearest = Window.partitionBy("qb", "part", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
