"""Benchmark passages in documents, by SimHash over windows of the items' sizes.

Only a window that shares a shingle of words with an item can be similar to it, so windows are laid where shingles of the
benchmark occur: for each shingle found, the window that the item would fill around it, and its neighbours. Every window gets
a 64-bit SimHash of its words. With radius r, the fingerprints are cut into r + 1 blocks: two fingerprints within the
radius agree on at least one whole block, so tables of the items by block find all of them. Candidates are then
verified by the exact weighted similarity of their shingles.

The items are divided into slices of a bounded size, and all slices are tried on a document in one reading. Their indexes, about
seven times the text of the benchmark, are built on the driver and sent to the executors. Nothing of a document is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens.llm.inputs import small_batches
from requestlens.llm.words import Words, pieces, split, sums_before
from requestlens.session import store

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 15
SLACK = 2
SLICE_BYTES = 8 << 20
# Weights are logarithms, so a similarity of exactly the threshold may come out a little below it.
_ROUNDING = 1e-9

FOUND = "array<struct<item_id:bigint,first_word:int,n_words:int,similarity:double>>"
_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())]))


def simhash(hashes: np.ndarray) -> int:
    """64 bits; each is set where more words have it than not."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(bits.sum(0, dtype=np.int64) * 2 > len(hashes), bitorder="little").tobytes(), "little")


@dataclass
class Item:
    item_id: int | None
    size: int
    shingles: Counter
    fingerprint: int
    weight: float = 0.0


@dataclass
class Index:
    """Items of a slice: shingles with the items and offsets they occur at, weights, and tables of items by block.

    ``foreign`` is the weight of a shingle that no item has; ``short`` are the items below ``SHINGLE`` words, by number of
    words and hash.
    """

    items: list[Item]
    weights: dict[int, float]
    foreign: float
    short: dict[tuple[int, int], list[int | None]] = field(default_factory=dict)
    places: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    blocks: list[dict[int, list[int]]] = field(default_factory=list)
    known: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))

    @staticmethod
    def block_bits() -> list[tuple[int, int]]:
        cuts = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
        return list(zip(cuts[:-1], np.diff(cuts).tolist(), strict=True))

    def near(self, fingerprint: int) -> list[int]:
        """Items within the radius."""
        found = {i for table, (at, bits) in zip(self.blocks, self.block_bits(), strict=True) for i in table.get(fingerprint >> at & (1 << bits) - 1, ())}
        return [i for i in found if (self.items[i].fingerprint ^ fingerprint).bit_count() <= RADIUS]

    def similarity(self, item: Item, shingles: Counter) -> float:
        """Sum of the smaller over sum of the larger weighted counts."""
        smaller = larger = 0.0
        for s in item.shingles.keys() | shingles.keys():
            a, b, w = item.shingles[s], shingles[s], self.weights.get(s, self.foreign)
            smaller += w * min(a, b)
            larger += w * max(a, b)
        return smaller / larger if larger else 0.0


def shingles_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of one sequence of words and their offsets; a shorter sequence is one shingle."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    length = min(SHINGLE, len(hashes))
    whole = Words(np.empty(0, np.uint8), np.empty(0, np.int64), np.arange(len(hashes)), np.arange(len(hashes)), np.array([0, len(hashes)]))
    return whole.windows(hashes, length)


def _item_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return split(data, np.array([0, len(data)])).hashes(lower=True)


def build(rows: list[tuple[int | None, str]], shared: dict[int, int] | None = None, total: int | None = None) -> Index:
    """An index of (id, text) items.

    A shingle weighs the less the more items of the benchmark share it: log(1 + items / items that have it). ``total`` is the
    number of items and ``shared`` that of the items with each shingle of several, over the whole benchmark; without them
    the rows are the whole benchmark. A shingle of no item weighs as much as one of a single item.
    """
    items, at, short = [], [], {}
    for item_id, text in rows:
        hashes = _item_words(text)
        found, offsets = shingles_of(hashes)
        if 0 < len(hashes) < SHINGLE:
            short.setdefault((len(hashes), int(found[0])), []).append(item_id)
        if len(hashes) < SHINGLE:
            continue
        items.append(Item(item_id, len(hashes), Counter(found.tolist()), simhash(hashes)))
        at.append((found, offsets))
    having = Counter(s for item in items for s in item.shingles)
    total = len(items) if total is None else total
    weights = {s: float(np.log(1 + total / (n if shared is None else shared.get(s, 1)))) for s, n in having.items()}
    for item in items:
        item.weight = sum(weights[s] * n for s, n in item.shingles.items())
    index = Index(items, weights, float(np.log(1 + total)), short)
    for i, (found, offsets) in enumerate(at):
        for s, o in zip(found.tolist(), offsets.tolist(), strict=True):
            index.places.setdefault(s, []).append((i, o))
    index.known = np.sort(np.array(list(index.places), dtype=np.uint64))
    for begin, bits in index.block_bits():
        table: dict[int, list[int]] = {}
        for i, item in enumerate(items):
            table.setdefault(item.fingerprint >> begin & (1 << bits) - 1, []).append(i)
        index.blocks.append(table)
    return index


def search(index: Index, texts: pa.Array) -> Iterator[list[tuple[int, int, int, float]]]:
    """For each text, (item, first word, words, similarity) of the best window of every item with a similar one.

    Windows are aligned with the item by a shingle that both have. Those whose fingerprint lies within the radius are
    verified, and so are those beyond it whose shared shingles, which are known exactly, weigh enough to reach the threshold.
    """
    # One bit per 20 leading bits of a known shingle rules out most of the others at once.
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[(index.known >> np.uint64(44)).astype(np.int64)] = True
    for _, words in pieces(texts):
        n = len(words.first) - 1
        results: list[list] = [[] for _ in range(n)]
        hashes = words.hashes(lower=True)
        counts = words.counts
        for t in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist() if index.short else []:
            own = hashes[int(words.first[t]): int(words.first[t + 1])]
            results[t] = [(i, 0, len(own), 1.0) for i in index.short.get((len(own), int(shingles_of(own)[0][0])), [])]
        shingles, at = words.windows(hashes, SHINGLE)
        hits = np.flatnonzero(maybe[(shingles >> np.uint64(44)).astype(np.int64)])
        if len(hits) and len(index.known):
            place = np.minimum(np.searchsorted(index.known, shingles[hits]), len(index.known) - 1)
            hits = hits[index.known[place] == shingles[hits]]
        if len(hits) and len(index.known):
            text = words.text_of()
            # For each text and item, the words where a shingle of the item begins, and the windows aligned with one of them.
            begins: dict[int, dict[int, set[int]]] = {}
            shared: dict[int, dict[int, dict[int, float]]] = {}
            for h in hits.tolist():
                word, shingle = int(at[h]), int(shingles[h])
                t = int(text[word])
                low, high = int(words.first[t]), int(words.first[t + 1])
                for i, offset in index.places[shingle]:
                    last = max(low, high - index.items[i].size)
                    aligned = {min(max(begin, low), last) for begin in range(word - offset - SLACK, word - offset + SLACK + 1)}
                    begins.setdefault(t, {}).setdefault(i, set()).update(aligned)
                    shared.setdefault(t, {}).setdefault(i, {})[word] = index.weights[shingle]
            for t, wanted in begins.items():
                best: dict[int, tuple[float, int, int]] = {}
                low, high = int(words.first[t]), int(words.first[t + 1])
                reaching = {(begin, min(index.items[i].size, high - begin)): set() for i, mine in wanted.items() for begin in mine}
                for i, mine in wanted.items():
                    place = sorted(shared[t][i])
                    upto = sums_before(np.array([shared[t][i][word] for word in place]))
                    for begin in mine:
                        size = min(index.items[i].size, high - begin)
                        inside = upto[bisect_right(place, begin + size - SHINGLE)] - upto[bisect_left(place, begin)]
                        # The larger sum is the item's own at least.
                        if inside >= THRESHOLD * index.items[i].weight * (1 - _ROUNDING):
                            reaching[begin, size].add(i)
                for begin, size in sorted(reaching):
                    own = hashes[begin: begin + size]
                    near = reaching[begin, size].union(index.near(simhash(own)))
                    if not near:
                        continue
                    counted = Counter(shingles_of(own)[0].tolist())
                    for i in sorted(near):
                        value = index.similarity(index.items[i], counted)
                        if value >= THRESHOLD - _ROUNDING and (i not in best or value > best[i][0]):
                            best[i] = (value, begin - low, size)
                found = [(index.items[i].item_id, begin, size, value) for i, (value, begin, size) in best.items()]
                results[t] = sorted(found, key=lambda row: (row[0] is None, row[0] or 0, *row[1:]))
        yield from results


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct shingle of each item of at least ``SHINGLE`` words."""
    for batch in batches:
        for text in batch["_text"].to_pylist():
            hashes = _item_words(text)
            if len(hashes) >= SHINGLE:
                found = np.unique(shingles_of(hashes)[0]).view(np.int64)
                # One row of each item is marked, so that marks count the items.
                yield pa.RecordBatch.from_pydict({"shingle": found, "whole": np.arange(len(found)) == 0})


def _slices(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the items, each item once, in slices of at most about ``SLICE_BYTES`` bytes of text.

    Weights come from the whole benchmark: where there are several slices, shingles are counted in Spark, and a slice gets
    the counts of those of its shingles that several items have.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("_text")).where(F.col("_text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("_text") + 16).alias("b")).first()["b"] or 0
    count = max(1, -(-size // SLICE_BYTES))
    if count == 1:
        rows = ((r["item_id"], r["_text"]) for r in items.collect())
        yield build(sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[1])))
        return
    items = store(items.withColumn("_slice", F.pmod(F.xxhash64("item_id", "_text"), F.lit(count))), "items")
    each = items.select("_slice", "_text")
    counted = each.mapInArrow(_item_shingles, "shingle long, whole boolean").groupBy("shingle").agg(F.count("*").alias("n"), F.count_if("whole").alias("items"))
    counted = store(counted, "shingle-counts")
    total = counted.agg(F.sum("items").alias("items")).first()["items"] or 0
    for k in range(count):
        mine = items.where(F.col("_slice") == k)
        own = mine.select("_text").mapInArrow(_item_shingles, "shingle long, whole boolean").select("shingle").distinct()
        shared = {r["shingle"] % (1 << 64): r["n"] for r in counted.where("n > 1").join(own, "shingle").select("shingle", "n").collect()}
        yield build([(r["item_id"], r["_text"]) for r in mine.collect()], shared, total)


def passages(text: Column, index: Index) -> Column:
    """Array of the benchmark passages in a text column, one for each item found."""
    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [[dict(item_id=i, first_word=b, n_words=n, similarity=s) for i, b, n, s in row] for row in search(index, texts)]
            yield pa.array(rows, _FOUND)

    return found(text)


def all_passages(text: Column, benchmark: DataFrame) -> Column:
    parts = [passages(text, index) for index in _slices(benchmark)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids, passages.

    Words and items compare without the case of A-Z. An item counts as found where some window of its number of words (the
    whole text, if that is shorter) has a weighted similarity of 0.8 or more on shingles of five words. ``item_ids`` are
    ascending; ``passages`` gives the best window of each item, the first of equal ones, by word offset. Null and empty texts are clean.
    Items of one to four words are one shingle, compared with whole texts of that many words. Items without an id are
    searched, and found under a null id, which comes last; null and empty items find nothing; repeated items count once.
    Repeated rows of a document are judged alike. Empty documents give no rows, an empty benchmark finds nothing.
    """
    small_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), all_passages(F.col("text"), benchmark).alias("passages"))
    return found.select(
        "doc_id", (F.size("passages") > 0).alias("contaminated"), F.array_sort(F.array_distinct(F.col("passages.item_id"))).alias("item_ids"), "passages"
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage, with all their columns.

    Null and empty texts stay, and so does everything where the benchmark is empty; repeated rows are judged alike.
    """
    small_batches(docs.sparkSession)
    return docs.where(F.size(all_passages(F.col("text"), benchmark)) == 0)
