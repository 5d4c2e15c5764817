"""Tokens of two tokenizers matched by the bytes they cover, and how often ids meet over all documents.

Tasks tokenize blocks of documents. A block is stored as one row, numbered by its task: what is known of each document at once, its segments by
number, the links of each distinct segment, and in how many of its documents each linked id pair occurs. Pairs are counted over
all blocks; each block then gets back the counts of its own distinct pairs, and sums them by segment and by document.
So a pair travels once for a block, not for an occurrence, and texts do not travel at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.llm.cover_trees import spread
from requestlens.llm.inputs import small_batches
from requestlens.llm.tokens import Segments, Tokenizers, distinct
from requestlens.session import fresh_path

TOKENIZERS = "/opt/tokenizers"
BLOCK_BYTES = 4 << 20
# Segments kept in a task from block to block, and the characters of them.
HELD, HELD_CHARS = 500_000, 48 << 20
# Rows of blocks in a file: a reader or writer in a task holds them at once, each of several MB.
FILE_BLOCKS = 4
_BLOCK = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, segments binary, segment_first binary, links binary, link_first binary, pair array<bigint>, docs array<int>"
)
_LISTS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


class _Documents:
    """The documents of a block while it is filled."""

    def __init__(self, tokenizers: Tokenizers, first: int = 0) -> None:
        self.tokenizers = tokenizers
        self.number = first
        self.known = Segments(tokenizers)
        self.rows: list[tuple[int | None, str]] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.rows.append((doc_id, text or ""))
        self.size += len(text or "") + 64

    def _numbered(self) -> list[np.ndarray]:
        """Segments of each document; of documents that a tokenizer changes, the whole text, or nothing if it still does."""
        none = np.empty(0, np.int64)
        found = [self.known.number(text) if text else none for _, text in self.rows]
        self.known.work_out()
        again = [n for n, mine in enumerate(found) if not self.known.exact[mine].all()]
        for n in again:
            found[n] = self.known.number_whole(self.rows[n][1])
        self.known.work_out()
        for n in again:
            if not self.known.exact[found[n]].all():
                found[n] = none
        return found

    def block(self) -> dict:
        found, known = self._numbered(), self.known
        lengths = np.array(list(map(len, found)), np.int64)
        flat = np.concatenate([np.empty(0, np.int64), *found])
        first = np.concatenate([[0], np.cumsum(lengths)])
        document = np.repeat(np.arange(len(found)), lengths)
        sums = np.zeros((len(found), 4), np.int64)
        for k in range(4):
            sums[:, k] = np.bincount(document, weights=known.counts[flat, k], minlength=len(found))
        digests = [hashlib.sha256(";".join(map(known.groups.__getitem__, mine.tolist())).encode()).hexdigest() if len(mine) else "" for mine in found]
        used, local = np.unique(flat, return_inverse=True)
        many = known.counts[used, 3]
        pair, links = np.unique(known.pairs[spread(known.first[used], many)], return_inverse=True)
        link_first = np.concatenate([[0], np.cumsum(many)])
        # Each document counts once for a pair, however often its segments have it.
        once = distinct((document << 32) | local)
        mine = once & 0xFFFFFFFF
        entries = np.repeat(once >> 32, many[mine]) * len(pair) + links[spread(link_first[mine], many[mine])]
        docs = np.bincount(distinct(entries) % max(1, len(pair)), minlength=len(pair))
        out = {
            "block": self.number, "doc_id": [doc_id for doc_id, _ in self.rows], "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3],
            "groups_sha256": digests, "segments": local.astype("<u4").tobytes(), "segment_first": first.astype("<i8").tobytes(),
            "links": links.astype("<u4").tobytes(), "link_first": link_first.astype("<i8").tobytes(), "pair": pair, "docs": docs.astype(np.int32),
        }
        self.rows, self.size, self.number = [], 0, self.number + 1
        if len(known.numbers) > HELD or sum(map(len, known.groups)) > HELD_CHARS:
            self.known = Segments(self.tokenizers)
        return out


def _released(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Give back what the C library holds of freed memory, which would add up over the blocks of a worker."""
    pa.system_memory_pool().release_unused()
    return batch


def _blocks(docs: DataFrame, folder: str) -> DataFrame:
    schema = pa.schema([
        ("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((name, pa.list_(pa.int64())) for name in _LISTS[1:5]), ("groups_sha256", pa.list_(pa.string())),
        ("segments", pa.binary()), ("segment_first", pa.binary()), ("links", pa.binary()), ("link_first", pa.binary()),
        ("pair", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = held or _Documents(Tokenizers(folder), TaskContext.get().partitionId() << 32)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                if held.rows and held.size > BLOCK_BYTES:
                    yield _released(pa.RecordBatch.from_pylist([held.block()], schema))
                held.add(doc_id, text.as_py())
        if held and held.rows:
            yield _released(pa.RecordBatch.from_pylist([held.block()], schema))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCK)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents an id pair is linked, and whether no pair of its A id is in more.

    There is one row for each A id in the comparison at most, so its size is bounded by the vocabulary.
    """
    pairs = blocks.select(F.inline(F.arrays_zip("pair", "docs"))).groupBy("pair").agg(F.sum("docs").alias("n"))
    path = fresh_path(blocks.sparkSession, "pair-counts")
    pairs.write.mode("errorifexists").parquet(path)
    pairs = blocks.sparkSession.read.schema(pairs.schema).parquet(path)
    a = F.shiftright("pair", 32)
    most = pairs.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return pairs.join(F.broadcast(most), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(counts: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of one block, from the counts of its distinct pairs, at their places in the block's list."""
    kinds = [(name, pa.string() if name == "groups_sha256" else pa.int64()) for name in [*_LISTS, "n_best", "count_sum"]]
    row = blocks.to_pylist()[0]
    first, link_first = (np.frombuffer(row[name], "<i8") for name in ("segment_first", "link_first"))
    segments, links = (np.frombuffer(row[name], "<u4") for name in ("segments", "links"))
    columns = {name: row[name] for name in _LISTS}
    for name, value in (("count_sum", "n"), ("n_best", "best")):
        of_pair = np.zeros(row["pairs"], np.int64)
        of_pair[counts["i"].to_numpy()] = counts[value].to_numpy()
        of_segment = np.diff(np.concatenate([[0], np.cumsum(of_pair[links])])[link_first])
        columns[name] = np.diff(np.concatenate([[0], np.cumsum(of_segment[segments])])[first])
    return pa.table([pa.array(columns[name], kind) for name, kind in kinds], pa.schema(kinds))


def align_documents(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of the documents.

    ``folder`` has the vocabulary files, on every machine. Repeated rows and rows without an id count as documents of their
    own. A null or empty text, and one that the piece tokenizer does not give back byte for byte (U+2581), has zeros and
    an empty digest. Whole texts are read, whatever their length; a text larger than a block is a block. An empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = fresh_path(spark, "token-blocks")
    _blocks(docs, folder).write.mode("errorifexists").options(compression="zstd", maxRecordsPerFile=FILE_BLOCKS).parquet(path)
    stored, again = (spark.read.schema(_BLOCK).parquet(path) for _ in range(2))
    pairs = stored.select(F.col("block").alias("of"), F.posexplode("pair").alias("i", "pair"))
    counts = pairs.join(pair_counts(stored), "pair").select("of", "i", "n", "best")
    blocks = again.select("block", *_LISTS, "segments", "segment_first", "links", "link_first", F.size("pair").alias("pairs"))
    done = counts.groupBy("of").cogroup(blocks.groupBy("block"))
    columns = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'bigint'}" for name in [*_LISTS, "n_best", "count_sum"])
    return done.applyInArrow(_summed, columns).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def aligned_groups(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, a_ids, b_ids, start, end) of every group of every document, with its byte range in the text after a space."""
    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("start", pa.int64()), ("end", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = None
        for batch in batches:
            tokenizers = tokenizers or Tokenizers(folder)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if not text:
                    continue
                _, a, b = tokenizers.encode(text)
                if not (a.exact and b.exact):
                    continue
                ends = np.intersect1d(a.end, b.end)
                cut_a, cut_b = np.searchsorted(a.end, ends, "right")[:-1], np.searchsorted(b.end, ends, "right")[:-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_id] * len(ends), pa.int64()),
                    pa.array([part.tolist() for part in np.split(a.ids, cut_a)], pa.list_(pa.int32())),
                    pa.array([part.tolist() for part in np.split(b.ids, cut_b)], pa.list_(pa.int32())),
                    pa.array(np.concatenate([[0], ends[:-1]])), pa.array(ends),
                ], [name for name, _ in fields])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, a_ids array<int>, b_ids array<int>, start bigint, end bigint"
    )
