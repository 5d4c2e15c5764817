"""Sharding, mixing and secrets against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from requestlens.llm import mixing, secrets, sharding
from tests.llm.rows import TEXTS, awkward, documents, nothing, words

FOLDER = "/root/testdata/sf0.001"


def given(spark, name="documents"):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def expected_shards(rows, count):
    sized = sorted(((i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows))
    total, before, out, slots = sum(r[3] for r in sized), 0, [], Counter()
    for null, i, crc, size in sized:
        shard = min(count - 1, (2 * before + size) * count // (2 * total))
        out.append((None if null else i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


@pytest.mark.parametrize("count", [1, 5, 24])
def test_shards_are_contiguous_and_even(spark, count):
    docs = given(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sharding.assign_shards(docs.repartition(7), count).collect()
    assert sorted([(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got], key=str) == expected_shards(rows, count)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_shards_of_awkward_rows(spark):
    got = sharding.assign_shards(awkward(spark), 4).collect()
    assert sorted([(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got], key=str) == expected_shards([(i, t) for i, t, _, _ in TEXTS], 4)
    assert sharding.assign_shards(nothing(spark)).collect() == []
    with pytest.raises(ValueError):
        sharding.assign_shards(nothing(spark), 0)


def test_sharded_documents_keep_their_texts(spark):
    docs = awkward(spark).withColumn("a.b", F.lit("dot")).withColumn("_row", F.lit(5))
    got = sharding.shard_documents(docs, 4)
    rows = got.collect()
    assert got.columns == [*sharding.COLUMNS, *[c for c in docs.columns if c not in sharding.COLUMNS]]
    assert sorted([tuple(r[:3]) + tuple(r[4:6]) for r in rows], key=str) == expected_shards([(i, t) for i, t, _, _ in TEXTS], 4)
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in rows) == Counter(TEXTS)
    assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) and r["a.b"] == "dot" and r["_row"] == 5 for r in rows)
    assert sharding.shard_documents(nothing(spark)).collect() == []


def test_shards_of_one_repeated_row(spark):
    rows = [(1, "same")] * 300
    got = sharding.assign_shards(documents(spark, rows, 5), 6).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [50] * 6
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(50)) for k in range(6))


def expected_targets(sizes):
    """By the rule as stated: share by weight, cut at three times the source, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 40, 1000, 90_000]) for s in rng.sample(["a", "b", "c", "Z", "é", "ß", "zz", "中", None], 7)}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = expected_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want


def check_mix(got, rows):
    sizes = defaultdict(int)
    for i, text, source in rows:
        sizes[source] += len(words(text))
    targets = expected_targets(dict(sizes))
    by_target = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.taken <= 3 * r["size"]
        assert r.taken == r.full_copies * r["size"] + r.part_words
        assert len(r.draws) == r.full_copies + (r.part_words > 0)
    for r in got:
        by_target[(r.source_size, round(r.target, 6))] += r.taken
    want = defaultdict(int)
    for s, size in sizes.items():
        want[(size, round(targets[s], 6))] += round(targets[s])
    assert {k: v for k, v in by_target.items() if v} == pytest.approx({k: v for k, v in want.items() if v}, abs=1)


def test_mix_meets_its_targets_and_reruns_agree(spark):
    docs = given(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    one, two = (sorted(mixing.mix_sources(docs.repartition(n)).collect()) for n in (3, 8))
    check_mix(one, rows)
    assert one == two


def test_mix_of_awkward_rows(spark):
    check_mix(mixing.mix_sources(awkward(spark)).collect(), [(i, t, s) for i, t, _, s in TEXTS])
    assert mixing.mix_sources(nothing(spark)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix_sources(nothing(spark), 3)


def test_mixed_documents_hold_the_words_taken(spark):
    docs = given(spark)
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    mixed = mixing.mixed_documents(docs).collect()
    assert mixing.mixed_documents(docs).columns == docs.columns
    held = Counter()
    for r in mixed:
        held[r.doc_id] += len(words(r.text))
    assert held == {i: n for i, n in taken.items() if n}
    assert sorted(mixing.mixed_documents(awkward(spark)).columns) == sorted(awkward(spark).columns)


def test_tree_keeps_every_quota(spark):
    quotas = {0: 1000, 1: 1, 2: 0, 3: 317, 4: 64}
    table = spark.createDataFrame(list(quotas.items()), "source_no int, draws long")
    for seed in range(3):
        got = mixing.split_quotas(table, 8, seed).collect()
        by_source, by_shard = Counter(), Counter()
        for r in got:
            assert r.draws >= 0
            by_source[r.source_no] += r.draws
            by_shard[r.shard] += r.draws
        assert by_source == {s: n for s, n in quotas.items()} or dict(by_source) == quotas
        assert max(by_shard.values()) - min(by_shard.values()) <= 3
        # 1,000 of 1,382 draws over 8 shards: 125 each, with a standard deviation of about 5.
        assert all(95 < r.draws < 155 for r in got if r.source_no == 0)
    assert mixing.split_quotas(table, 8, 1).collect() != mixing.split_quotas(table, 8, 2).collect()


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def expected_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def check_secrets(spark, rows):
    got = secrets.find_secrets(documents(spark, rows)).collect()
    want = []
    for i, text in rows:
        base = expected_base(text)
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base)
        n = Counter(k for _, k, _ in base)
        want.append((i, n[0], n[1], n[2], hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], key=str) == sorted(want, key=str)
    return {r.doc_id: r for r in got}


def test_base_secrets(spark):
    rng = random.Random(1)
    parts = [
        "password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " = ", "\"", "'", "abcdef", "a1b2c3", "short", "AKIA", "AKIA" + "B" * 16,
        "0123456789abcdef01234567", "é", "😀", " ", "\n", "  ", "deadbeef" * 4, "x", "-", "token: ", "ſecret=abcdefgh",
    ]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, "secret=token: abcdefgh"), (1001, "token=" * 500 + "abcdef"), (1002, "a" * 100_000 + " password = 'hunter22'")]
    check_secrets(spark, [*rows, *[(i, t) for i, t, _, _ in TEXTS if t is None or len(t) < 1000]])


def test_weak_parts_need_their_complement(spark):
    far = " word" * 300
    blob = "Zz9" * 13 + "Q"
    got = check_secrets(spark, [
        (1, f"client_id = app-17 and {blob} here"),
        (2, f"client_id = app-17 {far} {blob}"),
        (3, f"just {blob}"),
        (4, "login: someone alone"),
        (5, f"https://db.example/x AKIA{'A' * 16} password=abc12345"),
        (6, "https://db.example/x and no more"),
        (7, f"user_name=bob password=abc12345 {far} https://db.example/x"),
    ])
    assert {i: r.n_weak for i, r in got.items()} == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0, 7: 1}
    assert got[1].spans == "weak_access:0:18,weak_secret:23:63"
    assert got[5].spans.startswith("endpoint:0:20,access:21:41,assign:42:59")


WEAK = [
    (3, re.compile(r"""(?:access_?key_?id|client_?id|user_?name|user_?id|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{3,}""", re.I | re.A)),
    (4, re.compile(r"[A-Za-z0-9+/=]{40,}")),
    (5, re.compile(r"""(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp)://[^\x20\x09-\x0D"'<>]+""")),
]
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")


def expected_spans(text):
    """All pairs of parts by their true distance."""
    base = expected_base(text)
    weak = [(m.start(), k, m.end()) for k, p in WEAK for m in p.finditer(text) if k != 4 or len(m[0]) == 40]
    parts = base + [w for w in weak if not any(b[:2] <= w[:2] and b[2] >= w[2] for b in base)]
    beside = lambda p, kinds: any(q[1] in kinds and abs(q[0] - p[0]) <= 400 for q in parts)
    needs = {3: [(0, 2, 4)], 4: [(1, 3)], 5: [(1, 3), (0, 2, 4)]}
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(p for p in parts if all(beside(p, kinds) for kinds in needs.get(p[1], []))))


def test_linked_parts_by_true_distance(spark):
    rng = random.Random(9)
    parts = ["client_id=app-17 ", "Zz9" * 13 + "Q ", "https://db.example/x ", f"AKIA{'A' * 16} ", "password=abc12345 ", "login: bob ", "0123456789abcdef01234567 ", "é " * 60, "word " * 30]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows.append((1000, "".join(rng.choice(parts) for _ in range(5000))))
    got = check_secrets(spark, rows)
    assert {i: r.spans for i, r in got.items()} == {i: expected_spans(t) for i, t in rows}
    assert sum(r.n_weak for r in got.values()) > 500


def test_links_do_not_depend_on_the_offset(spark):
    block = "client_id = app-17 " + "x " * 130 + "Zz9" * 13 + "Q"
    got = check_secrets(spark, [(n, "é" * n + " " + block) for n in range(0, 900, 25)])
    assert {r.n_weak for r in got.values()} == {2}
    edge = check_secrets(spark, [(n, f"login: bob{' ' * (n - 10)}{'Zz9' * 13}Q") for n in (399, 400, 401)])
    assert [edge[n].n_weak for n in (399, 400, 401)] == [2, 2, 0]


def test_secrets_of_nothing(spark):
    assert secrets.find_secrets(nothing(spark)).collect() == []
    assert secrets.find_secrets(awkward(spark)).count() == len(TEXTS)
