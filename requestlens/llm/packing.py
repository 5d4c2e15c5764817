"""Compact columns of numbers, and the exchange of hashes by bucket that the deduplication operators share.

Sets of hashes are sent to buckets of the hash space. Rows of one hash each would cost several times the bytes, so a task
first gathers a block of documents, and sends every bucket one row with the block's sorted, distinct hashes, stored as
differences of the fewest bytes that hold them. A hash of very many documents thus reaches its bucket once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_ENTRIES = 1_000_000
BYTES_PER_WORD = 6


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in the fewest bytes that hold the largest; the first byte is that width."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def packed_ascending(values: np.ndarray) -> bytes:
    """Ascending whole numbers as the first and the differences."""
    if len(values) == 0:
        return b""
    return np.asarray(values[:1], dtype="<u8").tobytes() + packed(np.diff(values))


def unpacked_ascending(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    out = np.concatenate([np.frombuffer(blob, "<u8", 1), unpacked(blob[8:])])
    return np.cumsum(out, dtype=np.uint64)


def bucket_slices(hashes: np.ndarray, buckets: int, bits: int = 64) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty buckets of ascending hashes of ``bits`` bits; equal parts of the hash space."""
    high = (hashes >> np.uint64(max(0, bits - 32))).astype(np.float64) / 2.0 ** min(32, bits)
    bounds = np.searchsorted((high * buckets).astype(np.int64), np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(bounds)).tolist():
        yield bucket, int(bounds[bucket]), int(bounds[bucket + 1])


def text_bytes(texts: DataFrame, column: str) -> int:
    return texts.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"] or 0


def bucket_count(entries: float, most: int = BUCKET_ENTRIES) -> int:
    return max(8, -(-int(entries) // most))


def groups_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index of each run of equal values, run of each index) of sorted values."""
    opens = np.ones(len(values), dtype=bool)
    opens[1:] = values[1:] != values[:-1]
    return np.flatnonzero(opens), np.cumsum(opens) - 1
