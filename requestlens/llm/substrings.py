"""Removal of repeated word windows: Rabin-Karp hashes of all windows, the first document of each, merged intervals.

Tasks hash every window of the texts and gather blocks of documents. A block decides alone about a window that one of
its own earlier documents has; of every other window, one row per block travels to the bucket of its hash, where the
smallest document id over all blocks is found. What a bucket decides goes back to the block, whose windows are merged
into maximal intervals of words. So a passage in a third of all documents costs one entry per block, not per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestlens.llm.bitmap import mark
from requestlens.llm.inputs import small_batches
from requestlens.llm.packing import (
    BYTES_PER_WORD, bucket_count, bucket_slices, groups_of, packed, packed_ascending, text_bytes, unpacked, unpacked_ascending,
)
from requestlens.llm.words import mix, pieces
from requestlens.session import store

WINDOW = 13
BLOCK_WINDOWS = 2_000_000
NO_ID = (1 << 63) - 1

_POSTS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("least", pa.int64()), ("hashes", pa.binary()), ("checks", pa.binary()), ("ids", pa.binary()),
    ("places", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ("decided", pa.binary()), ("again", pa.binary()), ("again_as", pa.binary()),
])
POSTS = (
    "bucket int, block long, least long, hashes binary, checks binary, ids binary, places binary, doc_ids array<long>, keys array<long>, "
    "counts array<int>, decided binary, again binary, again_as binary"
)
_ANSWERS = pa.schema([x for x in _POSTS if x.name not in ("bucket", "least", "hashes", "checks", "ids")])
ANSWERS = "block long, places binary, doc_ids array<long>, keys array<long>, counts array<int>, decided binary, again binary, again_as binary"
_REMOVED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
REMOVED = "doc_id long, key long, starts array<int>, ends array<int>"


def check_bytes(windows: float) -> int:
    """Bytes beyond the 64-bit hash that keep the expected number of unequal windows taken for equal below 1 in 1,000."""
    return max(0, ceil((2 * log2(max(2.0, windows)) + 9 - 64) / 8))


class _Block:
    """Documents of one task until their windows fill a block."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.hashes, self.checks, self.rows, self.words = [], [], [], []
        self.ids, self.keys, self.counts = [], [], []
        self.size = self.word_count = 0

    def rows_out(self, buckets: int, length: int, width: int) -> Iterator[dict]:
        """Places are numbers of words, counted through the block's documents."""
        row = np.concatenate(self.rows)
        hashes, places = np.concatenate(self.hashes), np.concatenate(self.words)
        ids = np.array([NO_ID if i is None else i for i in self.ids], dtype=np.int64)
        order = np.argsort(hashes, kind="stable")
        if width:
            checks = np.concatenate(self.checks)
            order = np.lexsort((checks, hashes))
            checks = checks[order] >> np.uint64(64 - 8 * width)
        hashes, own, places = hashes[order], ids[row[order]], places[order]
        heads, group = groups_of(hashes) if not width else _groups_of_both(hashes, checks)
        least = np.minimum.reduceat(own, heads) if len(heads) else np.empty(0, np.int64)
        later = own > least[group]
        decided = np.sort(places[later])
        # Of the windows left, the first of each hash asks for all.
        left = np.flatnonzero(~later)
        first, run = groups_of(group[left])
        asks = left[first]
        repeats = np.ones(len(left), dtype=bool)
        repeats[first] = False
        again, again_as = places[left[repeats]], places[asks][run[repeats]]
        base = int(ids.min()) if len(ids) else 0
        for bucket, a, b in bucket_slices(hashes[asks], buckets):
            at = asks[a:b]
            yield {
                "bucket": bucket, "block": self.number, "least": base, "hashes": packed_ascending(hashes[at]),
                "checks": packed(checks[at]) if width else b"", "ids": packed((own[at] - base).astype(np.uint64)), "places": packed(places[at]),
            }
        yield {
            "bucket": self.number % buckets, "block": self.number, "doc_ids": self.ids, "keys": self.keys, "counts": self.counts,
            "decided": packed_ascending(decided), "again": packed(again), "again_as": packed(again_as),
        }


def _groups_of_both(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    opens = np.ones(len(hashes), dtype=bool)
    opens[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
    return np.flatnonzero(opens), np.cumsum(opens) - 1


def _post(batches: Iterator[pa.RecordBatch], buckets: int, length: int, width: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows for the buckets and one row about the documents of each block."""
    task = TaskContext.get().partitionId()
    made = 0
    block = _Block(task << 32)
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        for row, words in pieces(batch.column("text")):
            hashed = words.hashes()
            found, at = words.windows(hashed, length)
            n = len(words.first) - 1
            block.hashes.append(found)
            if width:
                block.checks.append(words.windows(mix(hashed), length, base=0x8CB92BA72F3D8DD7)[0])
            block.rows.append(words.text_of()[at] + len(block.ids))
            block.words.append(at + block.word_count)
            block.ids += ids[row: row + n]
            block.keys += keys[row: row + n]
            block.counts += words.counts.tolist()
            block.size += len(found)
            block.word_count += len(words.start)
            if block.size >= most:
                for out in block.rows_out(buckets, length, width):
                    yield pa.RecordBatch.from_pylist([out], schema=_POSTS)
                made += 1
                block = _Block((task << 32) + made)
    if block.ids:
        for out in block.rows_out(buckets, length, width):
            yield pa.RecordBatch.from_pylist([out], schema=_POSTS)


def _judge(table: pa.Table) -> pa.Table:
    """Of one bucket's windows, those whose hash stands in a smaller document of another block; back to their blocks."""
    out = []
    hashes, checks, ids, places, source = [], [], [], [], []
    blocks = []
    for row in table.select(["block", "least", "hashes", "checks", "ids", "places"]).to_pylist():
        if row["hashes"]:
            own = unpacked_ascending(row["hashes"])
            hashes.append(own)
            if row["checks"]:
                checks.append(unpacked(row["checks"]))
            ids.append(unpacked(row["ids"]).astype(np.int64) + row["least"])
            places.append(unpacked(row["places"]))
            source.append(np.full(len(own), len(blocks)))
            blocks.append(row["block"])
    if hashes:
        h, i, p, s = (np.concatenate(x) for x in (hashes, ids, places, source))
        order = np.lexsort((c := np.concatenate(checks), h)) if checks else np.argsort(h, kind="stable")
        heads, group = _groups_of_both(h[order], c[order]) if checks else groups_of(h[order])
        later = order[i[order] > np.minimum.reduceat(i[order], heads)[group]]
        later = later[np.argsort(s[later], kind="stable")]
        bounds = np.searchsorted(s[later], np.arange(len(blocks) + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            out.append({"block": blocks[k], "places": packed(p[later[bounds[k]: bounds[k + 1]]])})
    about = table.filter(pa.compute.is_valid(table.column("doc_ids"))).select(_ANSWERS.names)
    return pa.concat_tables([pa.Table.from_pylist(out, schema=_ANSWERS), about.cast(_ANSWERS)])


def _merge(table: pa.Table, length: int) -> pa.Table:
    """The removed words of one block's documents, as maximal intervals of word numbers, end exclusive."""
    about = table.filter(pa.compute.is_valid(table.column("doc_ids"))).to_pylist()
    if not about:
        return pa.Table.from_pylist([], schema=_REMOVED)
    about = about[0]
    counts = np.array(about["counts"], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.zeros(first[-1] + 1, dtype=bool)
    for blob in table.column("places").to_pylist():
        if blob:
            starts[unpacked(blob).astype(np.int64)] = True
    again, again_as = unpacked(about["again"]).astype(np.int64), unpacked(about["again_as"]).astype(np.int64)
    starts[again] = starts[again_as]
    starts[unpacked_ascending(about["decided"]).astype(np.int64)] = True
    at = np.flatnonzero(starts)
    edge = np.zeros(first[-1] + length + 1, dtype=np.int32)
    edge[at] += 1
    np.add.at(edge, at + length, -1)
    covered = (np.cumsum(edge)[: first[-1]] > 0)
    text = np.repeat(np.arange(len(counts)), counts)
    # Intervals open and close where coverage or the document changes.
    before = np.concatenate([[False], covered[:-1]]) if len(covered) else covered
    new = np.concatenate([[True], text[1:] != text[:-1]]) if len(covered) else covered
    opens = np.flatnonzero(covered & (~before | new))
    after = np.concatenate([covered[1:], [False]]) if len(covered) else covered
    ends_text = np.concatenate([text[1:] != text[:-1], [True]]) if len(covered) else covered
    closes = np.flatnonzero(covered & (~after | ends_text)) + 1
    owner = text[opens]
    heads, _ = groups_of(owner)
    bounds = np.append(heads, len(opens))
    touched = owner[heads] if len(heads) else np.empty(0, np.int64)
    offsets = pa.array(bounds, pa.int32())
    return pa.Table.from_arrays(
        [
            pa.array([about["doc_ids"][i] for i in touched], pa.int64()), pa.array([about["keys"][i] for i in touched], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(opens - first[owner], pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(closes - first[owner], pa.int32())),
        ],
        schema=_REMOVED,
    )


def repeated_intervals(docs: DataFrame, length: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, key, starts, ends): word intervals to remove; key is xxhash64 of the text. One row per text that loses any."""
    total = text_bytes(docs, "text")
    buckets, width = bucket_count(total / BYTES_PER_WORD), check_bytes(total / BYTES_PER_WORD)
    posts = docs.select("doc_id", "key", "text").mapInArrow(lambda batches: _post(batches, buckets, length, width, block_windows), POSTS)
    answers = posts.groupBy("bucket").applyInArrow(lambda table: _judge(table), ANSWERS)
    return answers.groupBy("block").applyInArrow(lambda table: _merge(table, length), REMOVED)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, ends = (batch.column(c).to_pylist() for c in ("text", "starts", "ends"))
        kept, sizes, removed = [], [], []
        for text, begin, end in zip(texts, starts, ends, strict=True):
            words = text.encode().split()
            sizes.append(len(words))
            gone = 0
            for a, b in zip(reversed(begin or ()), reversed(end or ()), strict=True):
                del words[a:b]
                gone += b - a
            removed.append(gone)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A window is ``length`` consecutive words, unchanged, of one document. Every word goes that lies in a window whose words also
    start somewhere in a document with a smaller doc_id; windows are judged on the input. A null id counts as larger than
    all others; rows of the same id do not remove each other's words. Null and empty texts have no words, texts of fewer
    words than a window lose none. Repeated rows get the same result each. An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    gone = store(repeated_intervals(rows, length, block_windows).dropDuplicates(["doc_id", "key"]), "removed")
    # Texts that lose nothing need not meet the intervals; all but a few of them are told by a bitmap, without a shuffle.
    marked = mark(rows, F.col("key"), gone, F.col("key"))
    touched, whole = marked.where("_marked").drop("_marked"), marked.where("NOT _marked").drop("_marked")
    joined = touched.join(gone, touched["doc_id"].eqNullSafe(gone["doc_id"]) & (touched["key"] == gone["key"]), "left")
    nothing = F.expr("cast(null as array<int>)")
    cut = joined.select(touched["doc_id"], "text", "starts", "ends").unionAll(whole.select("doc_id", "text", nothing.alias("starts"), nothing.alias("ends")))
    return cut.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
