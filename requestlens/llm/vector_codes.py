"""Compression of vectors to codes: each part of a vector is replaced by the nearest entry of its codebook.

Codebooks come from rounds of Lloyd's algorithm in whole numbers, so that results are the same on any cluster. Tasks gather
their vectors into blocks and build a cover tree for each part of a block once; the blocks are stored in the shared folder.
A round sends the codebooks to the tasks and gets back the sums and numbers of the vectors nearest to each entry: some
thousand numbers a task. Whole subtrees are assigned at once where the triangle inequality allows it.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.llm import cover_trees
from requestlens.llm.inputs import small_batches
from requestlens.llm.vectors import finite, matrix
from requestlens.session import store

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 22
# Below this, squared distances of up to 8,192 components and sums of 2**39 vectors fit 64-bit integers.
LARGEST = 1 << 24


def _rows(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, x) of the rows with a finite vector; x is null where a number is too large."""
    whole = F.transform(F.col("v"), lambda x: F.floor(x * F.lit(float(scale))).cast("int"))
    small = F.forall("v", lambda x: F.abs(x) < F.lit(LARGEST / scale))
    return (
        vectors.where(finite(F.col(vector)))
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
        .select("vec_id", "label", F.when(small, whole).alias("x"))
    )


def _seeds(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, one for each id: of several the first in order; all as long as the first of all."""
    fit = rows.where("x is not null and vec_id is not null")
    head = fit.orderBy("vec_id", "x").select(F.size("x").alias("n")).first()
    if head is None:
        return np.empty((0, 0), np.int64)
    fit = fit.where(F.size("x") == head["n"])
    ids = fit.select("vec_id").distinct().orderBy("vec_id").limit(entries)
    found = fit.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("x").alias("x")).collect()
    return np.array([row["x"] for row in sorted(found, key=lambda row: row["vec_id"])], np.int64).reshape(len(found), head["n"])


def _blocks(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """Blocks of a task's vectors: ids, labels, the numbers, and a cover tree for each part."""
    kind = rows.schema["label"].dataType.simpleString()
    most = max(64, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 4 * length)))
    width = length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows_: pa.Table) -> pa.RecordBatch:
            points = matrix(rows_["x"].combine_chunks(), length).astype(np.int64)
            trees = [cover_trees.build(np.ascontiguousarray(points[:, p * width: (p + 1) * width])) for p in range(parts)]
            lists = [pa.array([rows_[name].to_pylist()], pa.list_(rows_.schema.field(name).type)) for name in ("vec_id", "label")]
            blobs = [pa.array([blob]) for blob in (points.astype("<i4").tobytes(), pickle.dumps(trees))]
            return pa.RecordBatch.from_arrays([*lists, *blobs], ["ids", "labels", "points", "trees"])

        held: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows >= most:
                yield block(held.slice(0, most))
                held = held.slice(most)
        if held is not None and held.num_rows:
            yield block(held)

    return rows.mapInArrow(run, f"ids array<bigint>, labels array<{kind}>, points binary, trees binary")


def _unpacked(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[tuple[pa.RecordBatch, int, list[tuple[cover_trees.CoverTree, np.ndarray]]]]:
    width = length // parts
    for batch in batches:
        for i in range(batch.num_rows):
            points = np.frombuffer(batch["points"][i].as_py(), "<i4").reshape(-1, length).astype(np.int64)
            trees = pickle.loads(batch["trees"][i].as_py())
            yield batch, i, [(trees[p], np.ascontiguousarray(points[:, p * width: (p + 1) * width])) for p in range(parts)]


def _sums(codebooks: np.ndarray, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, _, halves in _unpacked(batches, length, parts):
            for p, (tree, points) in enumerate(halves):
                more, count = tree.sums(points, codebooks[p])
                total[p] += more
                number[p] += count
        yield pa.RecordBatch.from_pydict({
            "slot": np.arange(codebooks.size), "total": total.ravel(), "n": np.repeat(number.ravel(), width),
        })

    return run


def fit_codebooks(blocks: DataFrame, seeds: np.ndarray, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after all rounds. A round fetches one number for each position of each entry."""
    entries, length = seeds.shape
    codebooks = np.ascontiguousarray(seeds.reshape(entries, parts, length // parts).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = blocks.mapInArrow(_sums(codebooks, length), "slot bigint, total bigint, n bigint")
        moved = codebooks.ravel().copy()
        for row in sums.groupBy("slot").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            if row["n"]:
                moved[row["slot"]] = row["total"] // row["n"]
        codebooks = moved.reshape(codebooks.shape)
    return codebooks


def _codes(blocks: DataFrame, codebooks: np.ndarray, length: int) -> DataFrame:
    parts = len(codebooks)
    kind = blocks.schema["labels"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, halves in _unpacked(batches, length, parts):
            n = len(halves[0][1])
            codes, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
            for p, (tree, points) in enumerate(halves):
                found = tree.labels(points, codebooks[p])
                codes[:, p] = found
                error += np.einsum("ij,ij->i", points - codebooks[p][found], points - codebooks[p][found])
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch["ids"][i].values, batch["labels"][i].values, pa.array([text[at: at + 2 * parts] for at in range(0, len(text), 2 * parts)]), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return blocks.mapInArrow(run, f"vec_id bigint, label {kind}, code string, error bigint")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of the vectors, as a stored table, and the codebooks they refer to.

    Components become floor(scale * x). At most 256 entries. ``error`` is the squared distance to the chosen entries, summed over parts.

    Rows whose vector is null or has a null or non-finite component are left out. Every row counts, repeated ids and
    repeated rows too; rows without an id are coded, but never a first entry. A repeated id gives one first entry, of
    its smallest vector. With fewer ids than entries there are as many entries as ids; without any, codes and errors
    are null. A vector of another length than that of the smallest id, or with a component from 2**24 / scale on, keeps
    its row, with null code and error. The length must be a multiple of ``parts``. An empty table gives an empty result.
    Other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code has one byte for a part: at most 256 entries")
    small_batches(vectors.sparkSession)
    rows = _rows(vectors, vec_id, vector, label, scale)
    seeds = _seeds(rows, entries)
    length = seeds.shape[1]
    if not length:
        blank = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return blank, np.empty((parts, 0, 0), np.int64)
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    fits = F.coalesce(F.size("x") == length, F.lit(False)) & F.col("x").isNotNull()
    blocks = store(_blocks(rows.where(fits), length, parts), "vector-blocks")
    codebooks = fit_codebooks(blocks, seeds, parts, rounds)
    others = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return store(_codes(blocks, codebooks, length).unionByName(others), "vector-codes"), codebooks


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds the sum of the errors of all rows with the same label; rows without a label are together.

    The sums are stored first: Spark sends them to all tasks below its threshold, and otherwise joins by label, where
    a label of very many rows is split by the adaptive plan.
    """
    sums = store(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
