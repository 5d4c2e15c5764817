"""Document fingerprints by a homomorphic multiset hash over paragraphs.

A paragraph is a line with words. It is hashed to a wide vector, and a text's fingerprint is the sum of the vectors of its
paragraphs, modulo powers of two: the order of paragraphs does not matter, and a paragraph is inserted or deleted by
adding or subtracting its vector. The vector has two parts. Exact lanes, modulo 2**64, hash the paragraph as a whole and
settle equality. Similarity lanes, modulo 2**16, add a signed one for each pair of neighbouring words, so the squared
length of a difference estimates how many pairs of words two texts do not share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens.llm.inputs import small_batches
from requestlens.llm.sharding import positions
from requestlens.llm.words import mix, pieces
from requestlens.session import store

EXACT_LANES = 8
NEAR_LANES = 128
RANGE_BYTES = 32 << 20

_LANE_KEYS = mix(np.arange(1, EXACT_LANES + 1, dtype=np.uint64) * np.uint64(0x9E6C63D0676A9A99))


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(exact lanes as uint64, similarity lanes as uint16), a row per text; a text without words gives zeros."""
    exact, near = [np.empty((0, EXACT_LANES), np.uint64)], [np.empty((0, NEAR_LANES), np.uint16)]
    for _, words in pieces(texts):
        texts_here = len(words.first) - 1
        lanes = np.zeros((texts_here, EXACT_LANES), dtype=np.uint64)
        signs = np.zeros(texts_here * NEAR_LANES)
        if len(words.start):
            text = words.text_of()
            line = np.cumsum(words.data == 10)[words.start]
            opens = np.ones(len(text), dtype=bool)
            opens[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
            at = np.flatnonzero(opens)
            last = np.append(at[1:], len(text)) - 1
            hashed, whole = words.range_hashes([(words.start, words.end), (words.start[at], words.end[last])])
            for k, key in enumerate(_LANE_KEYS):
                # Sums of 64-bit values stay exact modulo 2**64.
                summed = np.concatenate([[np.uint64(0)], np.cumsum(mix(whole ^ key))])
                bounds = np.searchsorted(text[at], np.arange(texts_here + 1))
                lanes[:, k] = summed[bounds[1:]] - summed[bounds[:-1]]
            pair = hashed.copy()
            follows = np.flatnonzero(~opens)
            pair[follows] = mix(hashed[follows - 1] * np.uint64(3) + hashed[follows])
            # The first word of a paragraph stands alone where it is the only one.
            counted = ~opens
            counted[at[last == at]] = True
            pair, text = pair[counted], text[counted]
            sign = ((pair >> np.uint64(32)) & np.uint64(1)).astype(np.float64) * 2 - 1
            signs = np.bincount(text * NEAR_LANES + (pair % np.uint64(NEAR_LANES)).astype(np.int64), sign, texts_here * NEAR_LANES)
        exact.append(lanes)
        near.append(signs.astype(np.int64).reshape(-1, NEAR_LANES).astype(np.uint16))
    return np.concatenate(exact), np.concatenate(near)


def combine(a: bytes, b: bytes, sign: int = 1) -> bytes:
    """The fingerprint of both multisets of paragraphs together, or with ``sign`` -1 of a without those of b."""
    cut = 8 * EXACT_LANES
    exact = np.frombuffer(a[:cut], "<u8") + np.frombuffer(b[:cut], "<u8") * np.uint64(sign % (1 << 64))
    near = np.frombuffer(a[cut:], "<u2") + np.frombuffer(b[cut:], "<u2") * np.uint16(sign % (1 << 16))
    return exact.astype("<u8").tobytes() + near.astype("<u2").tobytes()


def encoded(exact: np.ndarray, near: np.ndarray) -> list[bytes]:
    return [a.tobytes() + b.tobytes() for a, b in zip(exact.astype("<u8"), near.astype("<u2"), strict=True)]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """1 for equal fingerprints; else 1 - |x - y|**2 / (|x|**2 + |y|**2) over the similarity lanes, between 0 and 1."""
    x, y = a[1].astype(np.int16).astype(np.float64), b[1].astype(np.int16).astype(np.float64)
    apart = (a[1] - b[1]).astype(np.int16).astype(np.float64)
    both = (x**2).sum(1) + (y**2).sum(1)
    near = np.clip(1 - (apart**2).sum(1) / np.maximum(both, 1), 0, 1)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, np.where(both > 0, np.minimum(near, 1 - 1e-9), 0.0))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def edit(text: str, after: str) -> str:
    """The text with its last quarter replaced by the beginning of the next one."""
    part = len(text) // 4
    return text[: len(text) - part] + after[:part]


def _results(ids: list, texts: list[str], prints: tuple[np.ndarray, np.ndarray], rows: list[int]) -> pa.RecordBatch:
    """Results of the given rows; each is edited by the row after it and compared with it."""
    edited = [edit(texts[i], texts[i + 1]) for i in rows]
    at = np.array(rows)
    own, after = (prints[0][at], prints[1][at]), (prints[0][at + 1], prints[1][at + 1])
    changed = fingerprints(pa.array(edited, pa.large_utf8()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[i] for i in rows], pa.int64()), pa.array([len(texts[i]) for i in rows], pa.int64()),
            pa.array([sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([x.hex() for x in encoded(*own)], pa.string()), pa.array([x.hex() for x in encoded(*changed)], pa.string()),
            pa.array(likeness(own, changed)), pa.array(likeness(own, after)),
        ],
        schema=_OUT,
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row with the next of its range; a range ends with a borrowed row, the first of the range after it.

    A row is compared when the next has come; only that one row is carried from batch to batch.
    """
    ranges, borrowed, ids, texts = [], [], [], []
    exact, near = np.empty((0, EXACT_LANES), np.uint64), np.empty((0, NEAR_LANES), np.uint16)
    for batch in batches:
        more = fingerprints(batch.column("_text"))
        ranges += batch.column("_range").to_pylist()
        borrowed += batch.column("_borrowed").to_pylist()
        ids += batch.column("doc_id").to_pylist()
        texts += batch.column("_text").to_pylist()
        exact, near = np.concatenate([exact, more[0]]), np.concatenate([near, more[1]])
        paired = [i for i in range(len(ids) - 1) if not borrowed[i] and ranges[i] == ranges[i + 1]]
        if paired:
            yield _results(ids, texts, (exact, near), paired)
        ranges, borrowed, ids, texts, exact, near = ranges[-1:], borrowed[-1:], ids[-1:], texts[-1:], exact[-1:], near[-1:]


def fingerprint_documents(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents follow each other by ascending doc_id, null last, equal ids by a hash of their texts and then in any order;
    after the last comes the first, and a single document follows itself. The edited text has its last
    floor(n_chars / 4) code points replaced by as many, or all, from the next text's beginning. Null texts count as empty; two
    texts without words have equal fingerprints. Fingerprints are hexadecimal: the exact lanes, then the similarity lanes,
    little-endian. Other columns are not read.

    Ranges are cut where the sum of the bytes before a row passes a multiple of ``range_bytes``, so they hold about as many
    bytes each, also where ids are null or repeat. Only ids, hashes and sizes are ordered for that. Texts are dealt once, a
    partition per range; a range is streamed in order and never held. The cuts, 32 bytes for each range, go to all tasks; on
    corpora of many TB take a larger ``range_bytes``, so that the shuffle has no more partitions than the cluster bears.
    """
    spark = docs.sparkSession
    small_batches(spark)
    last = (1 << 63) - 1
    # A row's number only parts rows of equal id and text, which give equal results wherever they lie: the first cut
    # inside such a group moves to its beginning, so no other row's range depends on how rows were numbered.
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    ).withColumns({"_tie": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    sizes = store(rows.select("_id", "_tie", "_row", (F.octet_length("_text") + 16).cast("long").alias("_bytes")), "sizes")
    cut = positions(sizes, ["_id", "_tie", "_row"], "_bytes").groupBy(F.expr(f"_before div {range_bytes}")).agg(F.min(F.struct("_id", "_tie", "_row")).alias("c"))
    # A row per range.
    cuts = sorted(tuple(r["c"]) for r in cut.collect())
    if not cuts:
        return spark.createDataFrame([], SCHEMA)
    cuts = [c if i and c[:2] == cuts[i - 1][:2] else (*c[:2], -1) for i, c in enumerate(cuts)]
    ranged = rows.withColumn("_range", _range_of(cuts[1:])(F.col("_id"), F.col("_tie"), F.col("_row"))).select("_range", "doc_id", "_id", "_tie", "_text")
    # Each range borrows a row: one with the id and the text that the range after it, or the first one, begins with.
    lenders = spark.createDataFrame([(c[0], c[1], i - 1 if i else len(cuts) - 1) for i, c in enumerate(cuts)], "_id long, _tie long, _to int")
    lent = (
        rows.join(F.broadcast(lenders.select("_id", "_tie").distinct()), ["_id", "_tie"], "left_semi").groupBy("_id", "_tie")
        .agg(F.first("doc_id").alias("doc_id"), F.first("_text").alias("_text"))
        .join(F.broadcast(lenders), ["_id", "_tie"]).select(F.col("_to").alias("_range"), "doc_id", "_id", "_tie", "_text")
    )
    ordered = (
        ranged.withColumn("_borrowed", F.lit(False)).unionByName(lent.withColumn("_borrowed", F.lit(True)))
        .repartitionById(len(cuts), F.col("_range"))
        .sortWithinPartitions("_range", "_borrowed", "_id", "_tie")
        .select("_range", "_borrowed", "doc_id", "_text")
    )
    return ordered.mapInArrow(_walk, SCHEMA)


def _range_of(cuts: list[tuple[int, int, int]]) -> Callable[[Column, Column, Column], Column]:
    """A column function: the number of cuts at or below (id, hash, row number)."""
    order = np.dtype([("id", "<i8"), ("tie", "<i8"), ("row", "<i8")])
    sorted_cuts = np.array(cuts, dtype=order)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, ties: pa.Array, numbers: pa.Array) -> pa.Array:
        keys = np.empty(len(ids), dtype=order)
        for name, column in (("id", ids), ("tie", ties), ("row", numbers)):
            keys[name] = column.to_numpy()
        return pa.array(np.searchsorted(sorted_cuts, keys, side="right"), pa.int32())

    return range_of
