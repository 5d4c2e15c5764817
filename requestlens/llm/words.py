"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of bytes other than space and the five control characters from tab to carriage return. All
separators are single bytes, so nothing here decodes text. Texts are handled in pieces of a bounded number of bytes; a
longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n at least; base is odd, so it has an inverse."""
    kept = _powers.get(base)
    if kept is None or len(kept[0]) < n:
        up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
        up[0] = down[0] = 1
        up[1:], down[1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        kept = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= 2 * PIECE_BYTES:
            _powers[base] = kept
    return kept


def sums_before(values: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, values.dtype)
    out[0] = 0
    np.cumsum(values, out=out[1:])
    return out


def _range_hashes(data: np.ndarray, ranges: list[tuple[np.ndarray, np.ndarray]], lower: bool) -> list[np.ndarray]:
    data = _LOWER[data] if lower else data
    up, down = powers(int(_BASE), len(data) + 1)
    total = sums_before(_BYTE_VALUE[data] * up[: len(data)])
    return [mix((total[end] - total[start]) * down[start]) for start, end in ranges]


@dataclass
class Words:
    """The words of a piece: byte ranges [start, end) in ``data``; the words of text i are first[i] to first[i + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of the bytes of each word; ``lower`` folds A-Z first."""
        return self.range_hashes([(self.start, self.end)], lower)[0]

    def range_hashes(self, ranges: list[tuple[np.ndarray, np.ndarray]], lower: bool = False) -> list[np.ndarray]:
        """Hashes of byte ranges, ascending and apart, from prefix sums; equal bytes have equal hashes.

        Only about a piece of the bytes is expanded at a time, or the longest range.
        """
        if len(self.data) <= 2 * PIECE_BYTES:
            return _range_hashes(self.data, ranges, lower)
        out = []
        for start, end in ranges:
            parts, at = [np.empty(0, np.uint64)], 0
            while at < len(start):
                to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE_BYTES, "right")))
                low = start[at]
                parts += _range_hashes(self.data[low: end[to - 1]], [(start[at:to] - low, end[at:to] - low)], lower)
                at = to
            out.append(np.concatenate(parts))
        return out

    def bare(self) -> tuple[np.ndarray, np.ndarray]:
        """Word ranges without up to three ASCII punctuation marks at either end; at least one byte stays."""
        start, end = self.start.copy(), self.end.copy()
        for _ in range(3):
            end -= _MARK[self.data[end - 1]] & (end - start > 1)
            start += _MARK[self.data[start]] & (end - start > 1)
        return start, end

    def windows(self, hashes: np.ndarray, length: int, base: int = 0xC2B2AE3D27D4EB4F) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp hashes of every ``length`` consecutive words of one text, and the index of their first words."""
        n = len(hashes)
        if n < length:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        up, down = powers(base, n + 1)
        total = sums_before(hashes * up[:n])
        text = self.text_of()
        at = np.flatnonzero(text[: n - length + 1] == text[length - 1:])
        return mix((total[at + length] - total[at]) * down[at]), at


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie between consecutive offsets of ``data``."""
    apart = _SEPARATOR[data]
    inside = ~apart
    opens = inside.copy()
    opens[1:] &= apart[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(data)]
    opens[bounds] = inside[bounds]
    closes = inside.copy()
    closes[:-1] &= apart[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = inside[last]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; a null counts as an empty text."""
    texts = texts.fill_null("").cast(pa.large_utf8())
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    if data is None or where[-1] == where[0]:
        return np.empty(0, np.uint8), where - where[0]
    return np.frombuffer(data, np.uint8)[where[0]: where[-1]], where - where[0]


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, Words]]:
    """(row of the first text, its words) for pieces of at most ``most`` bytes or of one text."""
    data, offsets = buffers(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, split(data[offsets[row]: offsets[to]], offsets[row: to + 1] - offsets[row])
        row = to
