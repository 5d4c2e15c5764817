"""Codes and neighbours of vectors against plain loops, on awkward rows."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from requestlens.llm import cover_trees
from requestlens.llm.neighbours import nearest_neighbours, quantised
from requestlens.llm.vector_codes import digest, encode_vectors, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, cell int, v int, qb int, rank int, x int, _label int"


def table(spark, rows, kind="float", partitions=3):
    schema = SCHEMA.replace("array<float>", f"array<{kind}>")
    return spark.createDataFrame([(i, v, label, "c", 1, 2, 3, 4, 5, 6, 7) for i, v, label in rows], schema).repartition(partitions)


def plane(rng, n, length=16, wide=1.0):
    return [[rng.gauss(0, wide) for _ in range(length)] for _ in range(n)]


def awkward(seed=3, n=90):
    rng = random.Random(seed)
    base = plane(rng, n)
    rows = [(i, v, i % 4 if i % 5 else None) for i, v in enumerate(base)]
    rows += [(n, None, 1), (n + 1, [*base[0][:15], None], 1), (n + 2, [*base[0][:15], math.nan], 1), (n + 3, [*base[0][:15], math.inf], None)]
    rows += [(n + 4 + i, base[50], 2) for i in range(40)] + [(n + 44, base[50], 2)] * 3
    rows += [(None, base[3], 1), (None, None, None), (-50, base[7], 0), (-7, [0.0] * 16, None)]
    return rows


def whole_numbers(rows):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return kept


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = whole_numbers(rows)
    width = len(kept[0][1]) // parts
    seeds = {}
    for i, v, _ in kept:
        if i is not None:
            seeds[i] = min(seeds.get(i, v), v)
    books = [[seeds[i][p * width:(p + 1) * width] for i in sorted(seeds)[:entries]] for p in range(parts)]

    def best(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            found = [best(p, v)[1] for _, v, _ in kept]
            for k in range(len(books[p])):
                mine = [v[p * width:(p + 1) * width] for (_, v, _), at in zip(kept, found) if at == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine)]
    out = []
    for i, v, label in kept:
        each = [best(p, v) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in each), sum(d for d, _ in each), label))
    return out, books


def test_codes_against_plain_loops(spark):
    rows = awkward()
    codes, books = encode_vectors(table(spark, rows))
    want, plain = plain_codes(rows)
    got = with_label_error(codes).collect()
    assert books.tolist() == plain
    assert sorted(((r.vec_id, r.code, r.error, r.label) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.label_error == sum(error for *_, error, label in want if label == r.label)
    assert len(digest(books)) == 64


def test_codes_do_not_depend_on_partitions(spark):
    rows = awkward(5)
    results = []
    for partitions in (1, 7):
        codes, books = encode_vectors(table(spark, rows, partitions=partitions))
        results.append((books.tolist(), sorted(map(repr, codes.collect()))))
    assert results[0] == results[1]


def test_fewer_ids_than_entries_and_odd_lengths(spark):
    rows = [(1, [0.5] * 8, None), (1, [0.25] * 8, None), (2, [0.5] * 8, 1), (3, [1.0] * 4, 1), (4, [5000.0] * 8, 1)]
    codes, books = encode_vectors(table(spark, rows))
    assert books.shape == (8, 2, 1)
    found = {(r.vec_id, r.code, r.error) for r in codes.collect()}
    assert (3, None, None) in found and (4, None, None) in found and len(found) == 5
    with pytest.raises(ValueError):
        encode_vectors(table(spark, [(1, [1.0] * 12, None)]))


def test_empty_tables(spark):
    for rows in ([], [(1, None, 2), (None, None, None)]):
        codes, books = encode_vectors(table(spark, rows))
        assert with_label_error(codes).count() == 0 and books.size == 0
        assert nearest_neighbours(table(spark, rows), F.col("vec_id") % 50 == 0).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.sampled_from([1, 3, 40, 4000]), st.integers(1, 16))
def test_cover_tree_finds_the_nearest_entry(seed, n, wide, entries):
    rng = np.random.default_rng(seed)
    points, books = rng.integers(-wide, wide + 1, (n, 3)), rng.integers(-wide, wide + 1, (entries, 3))
    tree = cover_trees.build(points, leaf=4)
    want = cover_trees.nearest(points, books)[0]
    squared = ((points[:, None, :] - books[None]) ** 2).sum(2)
    assert (want == squared.argmin(1)).all()
    assert (tree.labels(points, books) == want).all()
    total, number = tree.sums(points, books)
    for k in range(entries):
        assert number[k] == (want == k).sum() and (total[k] == points[want == k].sum(0)).all()


def test_cover_tree_assigns_whole_subtrees():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    points = np.concatenate([c + rng.integers(-20, 21, (200, 4)) for c in centres])
    tree = cover_trees.build(points)
    start, end, _, place, _ = tree.assign(points, centres)
    assert len(place) == 0 and (end - start).sum() == 1600 and len(start) <= 16
    for node in range(len(tree.centre)):
        children = range(tree.first[node], tree.first[node] + tree.many[node])
        assert all(4 * tree.radius2[c] <= tree.radius2[node] for c in children)


def plain_neighbours(rows, k=5):
    good = [(i, [float(x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i is not None and i % 50 == 0}:
        found = []
        for i, b in good:
            if i != q and len(a) == len(b):
                dot = sum(x * y for x, y in zip(a, b))
                found.append((-dot / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b)), i is None, i or 0))
        out += [(q, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(found)[:k], 1)]
    return out


def compared(found, want):
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    want = sorted(want)
    assert [(a, b, c) for a, b, c, _ in got] == [(a, b, c) for a, b, c, _ in want]
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want))


def test_neighbours_against_plain_loops(spark):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in awkward(11, 160)]
    rows += [(300, [1.0, 2.0], 1), (301, [2.0, 1.0], 1), (50, [3.0, 1.0], 1)]
    for partitions in (1, 5):
        compared(nearest_neighbours(table(spark, rows, partitions=partitions), F.col("vec_id") % 50 == 0), plain_neighbours(rows))


def test_fewer_candidates_than_asked_and_large_numbers(spark):
    rows = [(0, [1e200, 1e200], 1), (1, [1e-200, 2e-200], 1), (2, [-1e300, 0.0], 1)]
    found = nearest_neighbours(table(spark, rows, "double"), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2)]
    assert abs(found[0].score - 3 / math.sqrt(10)) < 1e-12 and abs(found[1].score + math.sqrt(0.5)) < 1e-12


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([2, 16, 300]))
def test_error_of_codes_is_a_bound(seed, length):
    vectors = np.random.default_rng(seed).normal(size=(20, length)) ** 3
    codes, scales, errors = quantised(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (codes.astype(float) @ codes.T.astype(float)) * scales[:, None] * scales[None, :]
    bound = errors[:, None] + (1 + errors[:, None]) * errors[None, :]
    assert (np.abs(unit @ unit.T - near) <= bound).all() and errors.max() < 0.05 * math.sqrt(length)
