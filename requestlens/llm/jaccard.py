"""Jaccard join of documents on word shingles, as a blocked sparse product of the document by shingle matrix.

The product's entries are overlaps of documents; only those within bounds derived from the sizes are worked out.

1. A linked document shares at least four fifths of its shingles. Tasks gather blocks of documents and exchange their shingle
   hashes by bucket; a document whose shingles are too rarely found elsewhere is done. For large documents a fixed part
   of the hash space bounds the number of unshared shingles as well.
2. Documents left with equal sets form a class. Classes count their shingles exactly; of each class the rarest shingles, as
   many as a linked class must share one of, are kept. Classes that share one fall into one candidate group.
3. A group is cut into blocks of rows of similar size. Each pair of blocks whose sizes can be linked is a cell of the product:
   one task multiplies the two blocks' shingle matrices and reports for each class its number of links and one edge.
4. The edges' components, and the classes' members, give every document its component.

Copies and near copies in any number thus meet block by block; no list of pairs is made.
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
from requestlens.llm.components import connected_components
from requestlens.llm.inputs import small_batches
from requestlens.llm.packing import (
    BYTES_PER_WORD, bucket_count, bucket_slices, groups_of, packed, packed_ascending, text_bytes, unpacked, unpacked_ascending,
)
from requestlens.llm.words import Words, mix, pieces
from requestlens.session import store

SHINGLE = 5
PERCENT = 80
BLOCK_ENTRIES = 1_500_000
BLOCK_ROWS = 60_000
# Documents of at least LARGE shingles are screened by a part of the hash space; smaller ones by all of it, and to compare alike
# with them so are those up to a quarter larger.
LARGE = 100
SCREENED_PART = 3 / 8
CELL_ROWS = 256
CELL_ENTRIES = 400_000


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle, with repeats; a text of one to four words is one shingle."""
    hashes = words.hashes(lower=True)
    found, at = words.windows(hashes, SHINGLE)
    text = words.text_of()[at]
    counts = words.counts
    short = [(k, np.flatnonzero(counts == k)) for k in range(1, SHINGLE)]
    parts, owners = [found], [text]
    for k, rows in short:
        if len(rows):
            value = np.zeros(len(rows), dtype=np.uint64)
            for j in range(k):
                value = mix(value * np.uint64(0x9FB21C651E98DF25) + hashes[words.first[rows] + j] + np.uint64(k))
            parts.append(value)
            owners.append(rows)
    return np.concatenate(parts), np.concatenate(owners)


def distinct_sets(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs once each, by hash and then row."""
    order = np.argsort(rows, kind="stable")
    order = order[np.argsort(hashes[order], kind="stable")]
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def set_keys(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the shingles of each row: equal sets have equal keys."""
    keys = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.zeros(n, dtype=np.uint64)
        np.add.at(total, rows, mix(hashes ^ np.uint64(salt)))
        keys.append(total.view(np.int64))
    return keys[0], keys[1]


_POSTS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("rows", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("text_keys", pa.list_(pa.int64())),
    ("sizes", pa.binary()), ("key1", pa.list_(pa.int64())), ("key2", pa.list_(pa.int64())), ("screened", pa.binary()), ("shared", pa.binary()),
])
POSTS = (
    "bucket int, block long, hashes binary, rows binary, doc_ids array<long>, text_keys array<long>, sizes binary, "
    "key1 array<long>, key2 array<long>, screened binary, shared binary"
)
_ANSWERS = pa.schema([("block", pa.int64()), ("rows", pa.binary()), ("counts", pa.binary()), *[x for x in _POSTS if x.name in ("doc_ids", "text_keys", "sizes", "key1", "key2", "screened", "shared")]])
ANSWERS = (
    "block long, rows binary, counts binary, doc_ids array<long>, text_keys array<long>, sizes binary, key1 array<long>, key2 array<long>, "
    "screened binary, shared binary"
)
_SETS = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_key", "n_shingles", "key1", "key2", "unshared")])
SETS = "doc_id long, text_key long, n_shingles long, key1 long, key2 long, unshared long"


def _screen_post(batches: Iterator[pa.RecordBatch], buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per block and bucket the block's distinct hashes, each with its row where only one row of the block has it; per block one row about its documents."""
    task = TaskContext.get().partitionId()
    held, ids, keys, made = [], [], [], 0
    entries = 0

    def out() -> Iterator[pa.RecordBatch]:
        number = (task << 32) + made
        hashes, rows = distinct_sets(np.concatenate([h for h, _ in held]), np.concatenate([r for _, r in held]))
        n = len(ids)
        sizes = np.bincount(rows, minlength=n)
        key1, key2 = set_keys(hashes, rows, n)
        part = np.uint64(int(SCREENED_PART * (1 << 32)) << 32)
        kept = (hashes < part) | (sizes < LARGE * 125 // 100 + 1)[rows]
        hashes, rows = hashes[kept] >> np.uint64(64 - bits), rows[kept]
        # What is screened of a large document is its part of the hash space alone.
        within = (hashes < (part >> np.uint64(64 - bits))) | (sizes < LARGE)[rows]
        screened = np.bincount(rows[within], minlength=n)
        heads, run = groups_of(hashes)
        many = np.bincount(run, minlength=len(heads)) > 1 if len(heads) else np.empty(0, bool)
        shared = np.bincount(rows[within & many[run]] if len(heads) else [], minlength=n)
        single = np.where(many | ~within[heads], 0, rows[heads] + 1)
        for bucket, a, b in bucket_slices(hashes[heads], buckets, bits):
            yield pa.RecordBatch.from_pylist(
                [{"bucket": bucket, "block": number, "hashes": packed_ascending(hashes[heads][a:b]), "rows": packed(single[a:b])}], schema=_POSTS
            )
        about = {
            "bucket": number % buckets, "block": number, "doc_ids": ids, "text_keys": keys, "sizes": packed(sizes), "key1": key1.tolist(), "key2": key2.tolist(),
            "screened": packed(screened), "shared": packed(shared),
        }
        yield pa.RecordBatch.from_pylist([about], schema=_POSTS)

    for batch in batches:
        more, more_keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
        for row, words in pieces(batch.column("text")):
            n = len(words.first) - 1
            hashes, rows = shingle_sets(words)
            held.append((hashes, rows + len(ids)))
            ids += more[row: row + n]
            keys += more_keys[row: row + n]
            entries += len(hashes)
            if entries >= BLOCK_ENTRIES or len(ids) >= BLOCK_ROWS:
                yield from out()
                held, ids, keys, entries, made = [], [], [], 0, made + 1
    if ids:
        yield from out()


def _screen_judge(table: pa.Table) -> pa.Table:
    """Of one bucket, the rows whose hash another block has too, counted per block."""
    hashes, rows, source, blocks = [], [], [], []
    for post in table.select(["block", "hashes", "rows"]).to_pylist():
        if post["hashes"]:
            own = unpacked_ascending(post["hashes"])
            hashes.append(own)
            rows.append(unpacked(post["rows"]).astype(np.int64))
            source.append(np.full(len(own), len(blocks)))
            blocks.append(post["block"])
    out = []
    if hashes:
        h, r, s = (np.concatenate(x) for x in (hashes, rows, source))
        order = np.argsort(h, kind="stable")
        heads, run = groups_of(h[order])
        told = order[(np.bincount(run) > 1)[run] & (r[order] > 0)]
        told = told[np.argsort(s[told], kind="stable")]
        bounds = np.searchsorted(s[told], np.arange(len(blocks) + 1))
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            of, counts = np.unique(r[told[bounds[k]: bounds[k + 1]]] - 1, return_counts=True)
            out.append({"block": blocks[k], "rows": packed(of), "counts": packed(counts)})
    about = table.filter(pa.compute.is_valid(table.column("doc_ids")))
    about = about.select(["block", "doc_ids", "text_keys", "sizes", "key1", "key2", "screened", "shared"]).to_pylist()
    return pa.Table.from_pylist(out + about, schema=_ANSWERS)


def _screen_merge(table: pa.Table) -> pa.Table:
    """One row per document of the block, with the number of screened shingles that no other document has."""
    about = table.filter(pa.compute.is_valid(table.column("doc_ids"))).to_pylist()
    if not about:
        return pa.Table.from_pylist([], schema=_SETS)
    about = about[0]
    shared = unpacked(about["shared"]).astype(np.int64)
    for row in table.select(["rows", "counts"]).to_pylist():
        if row["rows"]:
            shared[unpacked(row["rows"]).astype(np.int64)] += unpacked(row["counts"]).astype(np.int64)
    unshared = unpacked(about["screened"]).astype(np.int64) - shared
    columns = [about["doc_ids"], about["text_keys"], unpacked(about["sizes"]).astype(np.int64), about["key1"], about["key2"], unshared]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SETS)


def screened_sets(rows: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, key1, key2, unshared) per document of (doc_id, text_key, text)."""
    total = text_bytes(rows, "text") / BYTES_PER_WORD
    # Shortened hashes may only take unshared shingles for shared ones, which keeps more documents, never fewer.
    bits = min(64, max(40, ceil(log2(max(2.0, total))) + 13))
    buckets = bucket_count(total * SCREENED_PART)
    posts = rows.mapInArrow(lambda batches: _screen_post(batches, buckets, bits), POSTS)
    answers = posts.groupBy("bucket").applyInArrow(lambda table: _screen_judge(table), ANSWERS)
    return answers.groupBy("block").applyInArrow(lambda table: _screen_merge(table), SETS)


_CLASS = pa.schema([("rid", pa.int64()), ("tokens", pa.binary())])


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted shingles of each class from the text of one of its documents; rows whose text is not the class's are left out."""
    for batch in batches:
        classes, want1, want2 = (batch.column(c).to_numpy() for c in ("rid", "key1", "key2"))
        for row, words in pieces(batch.column("text")):
            n = len(words.first) - 1
            hashes, rows = distinct_sets(*shingle_sets(words))
            key1, key2 = set_keys(hashes, rows, n)
            order = np.argsort(rows, kind="stable")
            hashes, bounds = hashes[order], np.searchsorted(rows[order], np.arange(n + 1))
            good = np.flatnonzero((key1 == want1[row: row + n]) & (key2 == want2[row: row + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes[row + good], pa.int64()), pa.array([hashes[bounds[i]: bounds[i + 1]].astype("<u8").tobytes() for i in good], pa.binary())],
                schema=_CLASS,
            )


BLOCKS = "block long, rids array<long>, sets array<binary>"
_BLOCKS = pa.schema([("block", pa.int64()), ("rids", pa.list_(pa.int64())), ("sets", pa.list_(pa.binary()))])
COUNTS = "bucket int, block long, hashes binary, counts binary"
_COUNTS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
RARE = "token long, rid long"
_RARE = pa.schema([("token", pa.int64()), ("rid", pa.int64())])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of one task, many to a row."""
    number = TaskContext.get().partitionId() << 32
    rids, sets, entries = [], [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"block": number, "rids": rids, "sets": sets}], schema=_BLOCKS)

    for batch in batches:
        for rid, tokens in zip(batch.column("rid").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
            rids.append(rid)
            sets.append(tokens)
            entries += len(tokens) // 8
            if entries >= BLOCK_ENTRIES:
                yield out()
                rids, sets, entries, number = [], [], 0, number + 1
    if rids:
        yield out()


def _count_post(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """How many classes of a block have each shingle, by bucket."""
    for batch in batches:
        for block, sets in zip(batch.column("block").to_pylist(), batch.column("sets").to_pylist(), strict=True):
            tokens = np.sort(np.frombuffer(b"".join(sets), "<u8"))
            heads, run = groups_of(tokens)
            counts = np.bincount(run, minlength=len(heads))
            for bucket, a, b in bucket_slices(tokens[heads], buckets):
                row = {"bucket": bucket, "block": block, "hashes": packed_ascending(tokens[heads][a:b]), "counts": packed(counts[a:b])}
                yield pa.RecordBatch.from_pylist([row], schema=_COUNTS)


def _count_judge(table: pa.Table) -> pa.Table:
    """Exact counts over all blocks of one bucket's hashes, sent back to the blocks that have them; single ones are left out."""
    out, hashes, counts, blocks, bounds = [], [], [], [], [0]
    for post in table.to_pylist():
        hashes.append(unpacked_ascending(post["hashes"]))
        counts.append(unpacked(post["counts"]).astype(np.int64))
        blocks.append(post["block"])
        bounds.append(bounds[-1] + len(hashes[-1]))
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    _, run = groups_of(h[order])
    total = np.empty(len(h), dtype=np.int64)
    total[order] = np.bincount(run, c[order]).astype(np.int64)[run]
    for block, a, b in zip(blocks, bounds[:-1], bounds[1:], strict=True):
        found = np.flatnonzero(total[a:b] > 1) + a
        if len(found):
            out.append({"bucket": 0, "block": block, "hashes": packed_ascending(h[found]), "counts": packed(total[found])})
    return pa.Table.from_pylist(out, schema=_COUNTS)


def _rarest(counted: pa.Table, block: pa.Table) -> pa.Table:
    """The rarest shingles of each class of a block: so many that a linked class shares one; those of no other class are left out."""
    known, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for row in counted.to_pylist():
        known.append(unpacked_ascending(row["hashes"]))
        counts.append(unpacked(row["counts"]).astype(np.int64))
    known, counts = np.concatenate(known), np.concatenate(counts)
    if block.num_rows == 0 or len(known) == 0:
        return pa.Table.from_pylist([], schema=_RARE)
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    sets = block.column("sets")[0].as_py()
    tokens = np.frombuffer(b"".join(sets), "<u8")
    sizes = np.array([len(s) // 8 for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    count = np.where(known[at] == tokens, counts[at], 1)
    order = np.lexsort((tokens, count, row))
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    needed = sizes - -(-sizes * PERCENT // 100) + 1
    kept = order[(place < needed[row]) & (count[order] > 1)]
    rids = np.array(block.column("rids")[0].as_py(), dtype=np.int64)
    return pa.Table.from_arrays([pa.array(tokens[kept].view(np.int64)), pa.array(rids[row[kept]])], schema=_RARE)


def candidate_edges(sets: DataFrame, entries: float) -> DataFrame:
    """(a, b) edges that join all classes sharing one of their rarest shingles, without listing their pairs."""
    buckets = bucket_count(entries)
    blocks = store(sets.select("rid", "tokens").mapInArrow(_gather, BLOCKS), "blocks")
    posts = blocks.select("block", "sets").mapInArrow(lambda batches: _count_post(batches, buckets), COUNTS)
    counted = posts.groupBy("bucket").applyInArrow(lambda table: _count_judge(table), COUNTS)
    rarest = counted.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(lambda counts, block: _rarest(counts, block), RARE)
    rare = store(rarest, "rare")
    hubs = rare.groupBy("token").agg(F.min("rid").alias("hub"), F.count("*").alias("n")).where("n > 1").select("token", "hub")
    return rare.join(hubs, "token").where("rid <> hub").select(F.col("hub").alias("a"), F.col("rid").alias("b")).distinct()


LINKS = "rid long, root long, links long"
_LINKS = pa.schema([("rid", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def overlaps(tokens: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 1024) -> np.ndarray:
    """Numbers of common entries of the sets ``left`` with the sets ``right``, by products of 0/1 matrices, some columns at a time."""
    sizes = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(tokens)), sizes)
    order = np.argsort(flat, kind="stable")
    heads, run = groups_of(flat[order])
    shared = (np.bincount(run, minlength=len(heads)) > 1)[run] if len(heads) else np.empty(0, bool)
    order, run = order[shared], run[shared]
    _, column = np.unique(run, return_inverse=True)
    row = row[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    count = int(column.max()) + 1 if len(column) else 0
    for begin in range(0, count, columns):
        a, b = np.searchsorted(column, [begin, begin + columns])
        matrix = np.zeros((len(tokens), columns), dtype=np.float32)
        matrix[row[a:b], column[a:b] - begin] = 1
        total += matrix[left] @ matrix[right].T
    return total


def _cell(table: pa.Table) -> pa.Table:
    """Links of one cell: for each class with some, how many documents it is linked with here, and the smallest class it is joined with."""
    rows = table.sort_by([("side", "ascending"), ("rid", "ascending")]).select(["rid", "side", "tokens", "members"]).to_pylist()
    tokens = [np.frombuffer(r["tokens"], "<u8") for r in rows]
    side = np.array([r["side"] for r in rows])
    members = np.array([r["members"] for r in rows], dtype=np.int64)
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    n = len(rows)
    within = bool(table.column("diagonal")[0].as_py())
    left = np.arange(n) if within else np.flatnonzero(side == 0)
    right = left if within else np.flatnonzero(side == 1)
    common = np.rint(overlaps(tokens, left, right)).astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = 100 * common >= PERCENT * union
    if within:
        np.fill_diagonal(linked, False)
    links = np.zeros(n, dtype=np.int64)
    links[left] += linked @ members[right]
    if not within:
        links[right] += linked.T @ members[left]
    label = np.arange(n)
    while True:
        before = label.copy()
        if len(left) and len(right):
            label[left] = np.minimum(label[left], np.where(linked, label[right][None, :], n).min(1))
            label[right] = np.minimum(label[right], np.where(linked, label[left][:, None], n).min(0))
        if (label == before).all():
            break
    some = np.flatnonzero(links > 0)
    rids = np.array([r["rid"] for r in rows], dtype=np.int64)
    return pa.Table.from_arrays([pa.array(rids[some]), pa.array(rids[label[some]]), pa.array(links[some])], schema=_LINKS)


def cells(groups: DataFrame, sets: DataFrame, rows: int = CELL_ROWS, entries: int = CELL_ENTRIES) -> DataFrame:
    """The product's cells: (cell, side, rid, members, tokens).

    A group beyond one block is cut by size class, each at most a quarter larger than the one before, and then by hash, so
    blocks hold about ``rows`` classes and ``entries`` shingles. Classes of sizes that can be linked lie in the same or in
    neighbouring size classes, and only their blocks are paired.
    """
    sized = groups.join(sets.select("rid", "n_shingles", "members"), "rid")
    whole = sized.groupBy("component").agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_e"))
    one = (F.col("_n") <= rows) & (F.col("_e") <= entries)
    # Slightly above 1.25, so that rounding cannot part linked sizes by two classes.
    step = F.floor(F.log("n_shingles") / F.log(F.lit(1.2501)))
    classed = sized.join(whole, "component").select("component", "rid", "members", "n_shingles", F.when(one, 0).otherwise(step).cast("int").alias("_c"))
    blocks = classed.groupBy("component", "_c").agg(
        F.greatest(F.ceil(F.count("*") / rows), F.ceil(F.sum("n_shingles") / entries)).cast("int").alias("_k")
    )
    around = blocks.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("_c", "_k"))).alias("_ks"))
    placed = classed.join(around, "component").withColumn("_b", F.pmod(F.xxhash64("rid"), F.col("_ks")[F.col("_c")].cast("long")).cast("int"))
    paired = placed.select(
        "rid", "members", "component",
        F.explode(F.expr(
            "concat("
            "transform(sequence(0, _ks[_c] - 1), b -> named_struct('c1', _c, 'b1', least(b, _b), 'c2', _c, 'b2', greatest(b, _b), 'side', if(_b > b, 1, 0))),"
            "if(_ks[_c + 1] is null, array(), transform(sequence(0, _ks[_c + 1] - 1), b -> named_struct('c1', _c, 'b1', _b, 'c2', _c + 1, 'b2', b, 'side', 0))),"
            "if(_ks[_c - 1] is null, array(), transform(sequence(0, _ks[_c - 1] - 1), b -> named_struct('c1', _c - 1, 'b1', b, 'c2', _c, 'b2', _b, 'side', 1))))"
        )).alias("_at"),
    )
    return paired.select("rid", "members", F.struct("component", "_at.c1", "_at.b1", "_at.c2", "_at.b2").alias("cell"), F.col("_at.side").alias("side"), F.expr("_at.c1 = _at.c2 AND _at.b1 = _at.b2").alias("diagonal")).join(
        sets.select("rid", "tokens"), "rid"
    )


def link_documents(docs: DataFrame, cell_rows: int = CELL_ROWS, cell_entries: int = CELL_ENTRIES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    Words are compared without the case of A-Z. A document's set holds its distinct shingles of five words; one to four words
    make one shingle, and a document without words or text has an empty set, linked with nothing. Two documents link where
    100 * intersection >= 80 * union. ``component_id`` is the smallest doc_id reachable by links, the own one where there are
    none; ``n_links`` counts the other rows linked directly, copies included. Null ids take part in links; a component of null
    ids alone has a null id. Rows that repeat an id count as rows of their own. An empty table gives no rows; other
    columns are not read. ``cell_rows`` and ``cell_entries`` bound a block of the product, not the result.
    """
    return _linked(docs, cell_rows, cell_entries).drop("text_key")


def _linked(docs: DataFrame, cell_rows: int = CELL_ROWS, cell_entries: int = CELL_ENTRIES) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sets = store(screened_sets(rows), "sets")
    # Of n shingles at most n - ceil(0.8 n) may be unshared.
    likely = sets.where(f"n_shingles > 0 AND unshared <= n_shingles - ceil(n_shingles * {PERCENT} / 100)")
    classes = likely.groupBy("key1", "key2").agg(F.min("doc_id").alias("least"), F.count("*").alias("members"), F.first("n_shingles").alias("n_shingles"))
    classes = store(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    # Few documents stand for a class; the texts of most others stay where they are.
    maybe = mark(rows, F.col("doc_id"), classes, F.col("least")).where("_marked").drop("_marked")
    chosen = maybe.join(classes, maybe["doc_id"].eqNullSafe(classes["least"])).select("rid", "key1", "key2", "text")
    tokens = chosen.mapInArrow(_class_sets, "rid long, tokens binary").dropDuplicates(["rid"])
    known = store(tokens.join(classes.select("rid", "members", "n_shingles"), "rid"), "tokens")
    entries = classes.agg(F.sum("n_shingles").alias("e")).first()["e"] or 0
    groups = connected_components(candidate_edges(known, entries)).withColumnRenamed("node", "rid")
    links = store(cells(groups, known, cell_rows, cell_entries).groupBy("cell").applyInArrow(lambda table: _cell(table), LINKS), "links")
    joined = connected_components(links.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    joined = joined.join(classes.select(F.col("rid").alias("node"), "least"), "node")
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    direct = links.groupBy("rid").agg(F.sum("links").alias("links"))
    outcome = (
        classes.select("rid", "key1", "key2", "least", "members")
        .join(joined.select(F.col("node").alias("rid"), "component").join(smallest, "component").select("rid", "component_id"), "rid", "left")
        .join(direct, "rid", "left")
        .select("key1", "key2", F.coalesce("component_id", "least").alias("component_id"), (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    empty = F.col("n_shingles") == 0
    return sets.join(outcome, ["key1", "key2"], "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(empty, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The document of the smallest id of each component, with all columns.

    Rows that share this id count as one document and stay. Documents without words stay, and components of null ids alone.
    """
    found = _linked(docs).where("component_id IS NOT NULL AND NOT (doc_id <=> component_id)")
    gone = store(found.select(F.col("doc_id").alias("gone"), "text_key").distinct(), "gone")
    text_key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["gone"]) & (text_key == gone["text_key"]), "left_anti")
