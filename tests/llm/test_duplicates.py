"""Window removal, Jaccard join and decontamination against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from requestlens.llm import components, decontamination, jaccard, packing, substrings
from requestlens.llm.words import pieces
from tests.llm.rows import LONG, PASSAGE, TEXTS, awkward, documents, nothing, words

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
UPPER = {c: c - 32 for c in range(ord("a"), ord("z") + 1)}


def given(spark, name="documents"):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def expected_kept(rows, length):
    last = float("inf")
    texts = [(last if i is None else i, words(t)) for i, t in rows]
    first = {}
    for i, w in texts:
        for a in range(len(w) - length + 1):
            k = tuple(w[a: a + length])
            first[k] = min(first.get(k, last), i)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for a in range(len(w) - length + 1):
            if first[tuple(w[a: a + length])] < i:
                gone[a: a + length] = [True] * length
        out.append((None if i == last else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def removed(rows):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows], key=str)


@pytest.mark.parametrize(("seed", "block"), [(1, 1), (2, 40), (3, 10_000_000)])
def test_removed_windows(spark, seed, block):
    rng = random.Random(seed)
    runs = [rng.choices("abcde", k=rng.randint(1, 12)) for _ in range(12)]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(w for _ in range(rng.randint(0, 9)) for w in rng.choice(runs))) for i in range(120)]
    rows += [(7, "a b c d e a b"), (None, "a b c d e"), (None, None), (3, "x " * 200), (200, "x " * 90)]
    rng.shuffle(rows)
    assert removed(substrings.remove_repeats(documents(spark, rows, 5), 4, block).collect()) == expected_kept(rows, 4)


def test_removed_windows_of_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in given(spark).collect()]
    got = removed(substrings.remove_repeats(given(spark).repartition(6), block_windows=5000).collect())
    assert got == expected_kept(rows, 13)
    assert sum(r[2] for r in got) > 0


def test_removed_windows_of_awkward_rows(spark):
    assert removed(substrings.remove_repeats(awkward(spark)).collect()) == expected_kept([(i, t) for i, t, _, _ in TEXTS], 13)
    assert substrings.remove_repeats(nothing(spark)).collect() == []


def test_check_bytes_are_used(spark, monkeypatch):
    """The hash alone would already do here; with check bytes the result is the same."""
    monkeypatch.setattr(substrings, "check_bytes", lambda windows: 2)
    rows = [(i, " ".join(random.Random(i % 7).choices("abcdefgh", k=30))) for i in range(40)]
    assert removed(substrings.remove_repeats(documents(spark, rows), 4, 100).collect()) == expected_kept(rows, 4)
    monkeypatch.undo()
    assert [substrings.check_bytes(n) for n in (100, 2**27, 2**45)] == [0, 0, 5]


def test_packing():
    rng = np.random.default_rng(1)
    for top in (0, 5, 2**16, 2**40, 2**64 - 1):
        values = np.sort(rng.integers(0, top, 200, dtype=np.uint64, endpoint=True))
        assert (packing.unpacked(packing.packed(values)) == values).all()
        assert (packing.unpacked_ascending(packing.packed_ascending(values)) == values).all()
        found = [(b, i) for b, a, z in packing.bucket_slices(values, 9) for i in range(a, z)]
        assert [i for _, i in found] == list(range(200)) and all(0 <= b < 9 for b, _ in found)
    assert len(packing.unpacked(packing.packed(np.empty(0, np.uint64)))) == 0


def shingles(text):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected_links(rows):
    """Every pair of rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted([(i, len(sets[a]), least.get(find(a)), links[a]) for a, (i, _) in enumerate(rows)], key=str)


def linked(rows):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in rows], key=str)


def near_copies(rng, n):
    """Groups of texts that differ by a few words, around the threshold, with copies and common passages."""
    common = [f"c{i}" for i in range(30)]
    rows, at = [], 0
    while at < n:
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 60, 130, 160]))]
        if rng.random() < 0.4:
            base[len(base) // 2:len(base) // 2] = common[: rng.randint(5, 30)]
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = f"v{rng.randint(0, 50)}"
            text = text[: len(text) - rng.randint(0, len(text) // 8)]
            rows.append((at, " ".join(text).replace("w1", "W1" if rng.random() < 0.5 else "w1")))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "cell"), [(1, 256), (2, 3), (3, 1)])
def test_links(spark, seed, cell):
    rows = near_copies(random.Random(seed), 220) + [(5, "again"), (5, "Again"), (None, "again"), (None, "alone"), (900, ""), (901, None)]
    assert linked(jaccard.link_documents(documents(spark, rows, 4), cell).collect()) == expected_links(rows)


def test_links_within_one_large_group(spark):
    """Chains of small changes in cells of four rows: everything is one component, without all pairs being linked."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        base = list(base)
        base[(i * 7) % 120] = f"x{i}"
        rows.append((1000 - i, " ".join(base)))
    got = jaccard.link_documents(documents(spark, rows), cell_rows=4, cell_entries=700).collect()
    assert linked(got) == expected_links(rows)
    assert {r.component_id for r in got} == {941}


def test_links_over_blocks(spark):
    """Nine tasks: what the block of one has is looked up in all others."""
    rows = [(r.doc_id, r.text) for r in given(spark).collect()]
    got = linked(jaccard.link_documents(given(spark).repartition(9)).collect())
    assert got == expected_links(rows)
    assert any(r[0] != r[2] for r in got)


def test_links_of_awkward_rows(spark):
    rows = [(i, t) for i, t, _, _ in TEXTS]
    assert linked(jaccard.link_documents(awkward(spark)).collect()) == expected_links(rows)
    assert jaccard.link_documents(nothing(spark)).collect() == []
    kept = jaccard.keep_one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([-5, 1, 2, 3, 4, 5, 6, 8, 9, 12, 15, None], key=str)


@pytest.mark.parametrize("most", [components.EDGES_OF_A_TASK, 20, 0])
def test_components(spark, most):
    rng = random.Random(9)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(40)] + [(3000, 3001 + i) for i in range(50)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), most).collect()}
    loops = {n for n in parent if all(a == b for a, b in edges if n in (a, b))}
    assert set(got) == set(parent) - loops
    groups = {}
    for n, c in got.items():
        groups.setdefault(c, set()).add(find(n))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(n) for n in got})
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), most).collect() == []


def similar_windows(items, text):
    """All windows of every item's size, with shingles and weights worked out on their own."""
    def shingles(w):
        return Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))

    known = [(i, words((t or "").translate(LOWER))) for i, t in items]
    known = [(i, w, shingles(w)) for i, w in known if len(w) >= 5]
    having = Counter(s for *_, counted in known for s in counted)
    own, found = words((text or "").translate(LOWER)), set()
    all_own = set(shingles(own))
    for item_id, w, counted in known:
        if all_own.isdisjoint(counted):
            continue  # nothing shared, similarity 0
        size = min(len(w), len(own))
        for a in range(len(own) - size + 1):
            window = shingles(own[a: a + size])
            weigh = {s: math.log(1 + len(known) / max(1, having[s])) for s in window.keys() | counted.keys()}
            smaller = sum(weigh[s] * min(window[s], counted[s]) for s in weigh)
            larger = sum(weigh[s] * max(window[s], counted[s]) for s in weigh)
            if larger and smaller / larger >= 0.8 - 1e-9:
                found.add(item_id)
    return found


def test_similarity_does_not_depend_on_other_items_or_slices(spark, monkeypatch):
    rng = random.Random(12)
    item = [f"q{i}" for i in range(59)]
    text = " ".join([*item[:53], *(f"x{i}" for i in range(6))])
    others = [(i + 1, " ".join(f"z{rng.randint(0, 10**6)}" for _ in range(30))) for i in range(98)]
    for items in ([(0, " ".join(item))], [(0, " ".join(item)), *others]):
        for size in (decontamination.SLICE_BYTES, 3000):
            monkeypatch.setattr(decontamination, "SLICE_BYTES", size)
            benchmark = spark.createDataFrame(items, "item_id long, text string")
            passages = decontamination.find_contamination(documents(spark, [(1, text)]), benchmark).first().passages
            assert [(p.item_id, round(p.similarity, 6)) for p in passages] == [(0, round(49 / 61, 6))]


def test_shared_shingles_weigh_alike_in_every_slice(spark, monkeypatch):
    rng = random.Random(13)
    shared = " ".join(f"s{i}" for i in range(12))
    items = [(i, f"{shared} " + " ".join(f"i{i}_{rng.randint(0, 99)}" for _ in range(25))) for i in range(40)]
    rows = [(i, t.rsplit(" ", rng.randint(0, 4))[0]) for i, t in items] + [(100, shared)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    results = []
    for size in (decontamination.SLICE_BYTES, 2000):
        monkeypatch.setattr(decontamination, "SLICE_BYTES", size)
        found = decontamination.find_contamination(documents(spark, rows), benchmark).collect()
        results.append({r.doc_id: [(p.item_id, p.first_word, round(p.similarity, 9)) for p in sorted(r.passages, key=lambda p: p.item_id)] for r in found})
    assert results[0] == results[1] and sum(map(len, results[0].values())) >= 30


def test_short_items_and_items_without_an_id(spark):
    benchmark = spark.createDataFrame([(7, "One two"), (None, PASSAGE), (8, "a b c d"), (9, ""), (10, None)], "item_id long, text string")
    rows = [(1, " one\tTWO "), (2, "one two three"), (3, f"before {PASSAGE} after"), (4, "a b c d"), (5, ""), (6, None), (7, "one")]
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontamination.find_contamination(documents(spark, rows), benchmark).collect()}
    assert got == {1: (True, [7]), 2: (False, []), 3: (True, [None]), 4: (True, [8]), 5: (False, []), 6: (False, []), 7: (False, [])}


def test_contamination_against_all_windows(spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"q{rng.randint(0, 60)}" for _ in range(rng.randint(8, 45)))) for i in range(25)]
    rows = []
    for i in range(150):
        text = [f"w{rng.randint(0, 200)}" for _ in range(rng.randint(0, 60))]
        if i % 2:
            part = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.choice([0, 1, len(part) - 1, rng.randrange(len(part))])] = "changed"
            part = part[rng.randint(0, 2):]
            text[len(text) // 2:len(text) // 2] = [w.upper() if rng.random() < 0.2 else w for w in part]
        rows.append((i, " ".join(text)))
    benchmark = spark.createDataFrame([*items, (99, None), (98, "too short"), items[0]], "item_id long, text string")
    got = {r.doc_id: set(r.item_ids) - {None} for r in decontamination.find_contamination(documents(spark, rows), benchmark).collect()}
    want = {i: similar_windows(items, t) for i, t in rows}
    missed = sum(len(want[i] - got[i]) for i in want)
    assert all(got[i] <= want[i] for i in want)
    assert missed == 0 and sum(len(w) for w in want.values()) > 30


@pytest.mark.parametrize("size", [59, 200])
def test_windows_at_the_threshold_are_found(spark, size):
    rng = random.Random(size)
    items = [(i, " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(size))) for i in range(20)]
    rows = []
    for i, t in items:
        w, most = t.split(), (size - 4) // 9
        run = rng.choice([most, most, most - 1, most + 1])
        at = rng.choice([0, size - run])
        w[at: at + run] = [f"x{rng.randint(0, 10**6)}" for _ in range(run)]
        rows.append((i, " ".join([f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 40))] + w)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: set(r.item_ids) for r in decontamination.find_contamination(documents(spark, rows), benchmark).collect()}
    assert got == {i: similar_windows(items, t) for i, t in rows} and 6 < sum(map(len, got.values())) < 20


def test_whole_items_are_always_found(spark):
    items = [(r.item_id, r.text) for r in given(spark, "benchmark").collect()]
    rows = [(i, f"{LONG[: 50 * i]} {t} and so on") for i, t in items] + [(1000 + i, t.translate(UPPER).replace(" ", "\n")) for i, t in items] + [(5000, LONG)]
    got = {r.doc_id: r for r in decontamination.find_contamination(documents(spark, rows), given(spark, "benchmark")).collect()}
    assert all(i in got[i].item_ids and i in got[1000 + i].item_ids for i, _ in items)
    assert not got[5000].contaminated
    place = next(p for p in got[0].passages if p.item_id == 0)
    assert place.similarity == 1.0 and place.n_words == len(items[0][1].split())


def test_contamination_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 2000)
    got = decontamination.find_contamination(given(spark), given(spark, "benchmark")).collect()
    monkeypatch.undo()
    whole = decontamination.find_contamination(given(spark), given(spark, "benchmark")).collect()
    assert {r.doc_id: r.item_ids for r in got if r.contaminated} == {r.doc_id: r.item_ids for r in whole if r.contaminated}


def test_contamination_of_awkward_rows(spark):
    benchmark = spark.createDataFrame([(1, PASSAGE.upper())], "item_id long, text string")
    got = decontamination.find_contamination(awkward(spark), benchmark).collect()
    assert len(got) == len(TEXTS)
    assert all(r.contaminated == (r.doc_id in (1, 2, 10, 11) or (r.doc_id is None and len(r.passages) > 0)) for r in got)
    assert sum(r.contaminated for r in got) == 6
    assert decontamination.keep_uncontaminated(awkward(spark), benchmark).count() == len(TEXTS) - 6
    assert decontamination.find_contamination(nothing(spark), benchmark).collect() == []
    empty = decontamination.find_contamination(awkward(spark), benchmark.limit(0)).collect()
    assert len(empty) == len(TEXTS) and not any(r.contaminated for r in empty)
