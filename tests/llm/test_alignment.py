"""Aligned tokens against the definition: whole texts, tokens one by one, all overlaps."""

import gc
import hashlib
import json
import os
import weakref
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from requestlens.llm import alignment
from requestlens.llm.alignment import TOKENIZERS, align_documents, aligned_groups
from requestlens.llm.tokens import Segments, Tokenizers, cut_ends, runs, segments
from tests.llm.rows import LONG, TEXTS, awkward, documents, nothing

MORE = [
    "a  b   c\n\nd\te ", " x", "x ", "   ", "\n", "It's  they'll 'd 's ' s", "<|endoftext|> <s></s> <unk> <0x41>", "café \U0001f937\U0001f3fd‍♀️ 日本語のテキスト ﬁ",
    "a ▁ b", "▁", "1234567 12,5 a1b2", "\x00 \x85 \x1c a\x1f b 　 ​", "آها नमस्ते", "x" * 5000 + " " + "é" * 3000, "word " * 400,
    "᠎ a ᠎", "é ́x 힣가", "﻿a �￾ b",
]
LETTERS = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
LETTERS |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(LETTERS.values())))}


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")


def plain(both, text):
    """(A ids, B ids, groups, links) of a text, from the decoded bytes of its tokens alone."""
    if not text:
        return [], [], [], []
    a, b = both
    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left_bytes = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in left]
    pieces = [b.id_to_piece(i) for i in right]
    right_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(left_bytes) == b"".join(right_bytes) == b" " + text.encode():
        return [], [], [], []
    spans = []
    for sizes in (map(len, left_bytes), map(len, right_bytes)):
        ends = np.cumsum(list(sizes)).tolist()
        spans.append(list(zip([0, *ends], ends)))
    common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for high in common:
        sides = [[i for i, (s, e) in zip(ids, where) if low <= s and e <= high] for ids, where in zip((left, right), spans)]
        groups.append("|".join(",".join(map(str, side)) for side in sides))
        low = high
    links, k = [], 0
    for i, (s, e) in zip(left, spans[0]):
        while k and spans[1][k - 1][1] > s:
            k -= 1
        while k < len(right) and spans[1][k][0] < e:
            if spans[1][k][1] > s:
                links.append((i, right[k]))
            k += 1
    return left, right, groups, links


def expected(both, rows):
    found = [(i, *plain(both, text)) for i, text in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((
        i, len(a), len(b), len(groups), len(links), sum(counts[pair] == best[pair[0]] for pair in links), sum(counts[pair] for pair in links),
        hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
    ) for i, a, b, groups, links in found), key=repr)


def test_documents_against_the_definition(spark, both):
    rows = [(i, text) for i, text, *_ in TEXTS if text != LONG] + [(100 + n, text) for n, text in enumerate(MORE)] + [(100, MORE[0]), (None, MORE[1])]
    rows += [(200, LONG[:9_000])]
    for partitions in (1, 6):
        got = align_documents(documents(spark, rows, partitions))
        assert sorted(map(tuple, got.collect()), key=repr) == expected(both, rows)


def test_awkward_tables(spark):
    found = align_documents(awkward(spark)).collect()
    assert len(found) == len(TEXTS)
    assert all(r.n_a == 0 and r.groups_sha256 == "" for r in found if r.doc_id in (3, 4))
    assert align_documents(nothing(spark)).count() == 0


def test_groups_give_the_text_back(spark, both):
    rows = [(n, text) for n, text in enumerate(MORE)]
    found = aligned_groups(documents(spark, rows)).collect()
    for n, text in rows:
        mine = sorted((r for r in found if r.doc_id == n), key=lambda r: r.start)
        assert [f"{','.join(map(str, r.a_ids))}|{','.join(map(str, r.b_ids))}" for r in mine] == plain(both, text)[2]
        assert all(x.end == y.start for x, y in zip(mine, mine[1:])) and (not mine or mine[-1].end == len(text.encode()) + 1)


@pytest.fixture(scope="module")
def tokenizers():
    return Tokenizers(TOKENIZERS)


alphabet = st.sampled_from([" ", "  ", "\n", "\t", "a", "The", "'s", "'", "1", "é", "\U0001f600", "日", ".", "-", " ", " ", "　", "\x1c", "▁", "ing", "<s>", "\r\n", "́", "‍"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(alphabet, max_size=14).map("".join), st.text(max_size=20)))
def test_segments_are_tokenized_like_whole_texts(both, tokenizers, text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    known = Segments(tokenizers)
    numbers = known.number(text)
    known.work_out()
    a, b, groups, links = plain(both, text)
    if text and known.exact[numbers].all():
        assert known.counts[numbers].sum(axis=0).tolist() == [len(a), len(b), len(groups), len(links)]
        assert ";".join(known.groups[n] for n in numbers) == ";".join(groups)
    else:
        assert "▁" in text or not a


def test_runs_of_a_long_text():
    text = "a  b\nc d " * 50 + "e" * 40 + " f"
    for most in (1, 7, 30, 10**6):
        parts = list(runs(text, most))
        assert " ".join(parts) == text and [s for part in parts for s in segments(part)] == segments(text)


def test_ends_between_coarse_cuts_follow_from_bytes():
    # Five characters of 1, 4, 1, 2, 1 bytes; the second is three tokens, the last two one token with an empty span before it.
    byte_at = np.array([0, 1, 5, 6, 8, 9])
    start, end = np.array([0, 1, 1, 1, 2, 3, 3]), np.array([1, 2, 2, 2, 3, 3, 5])
    assert cut_ends(np.array([1, 2, 1, 1, 1, 1, 2]), start, end, byte_at).tolist() == [1, 3, 4, 5, 6, 7, 9]


def test_every_entry_has_its_bytes(tokenizers):
    with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as source:
        vocabulary = json.load(source)["model"]["vocab"]
    assert all(tokenizers.a_bytes[i] == bytes(LETTERS[c] for c in entry) for entry, i in vocabulary.items())
    # No piece has a space after another character; cutting texts at lone spaces rests on it.
    assert not any(b" " in piece.lstrip(b" ") for piece in tokenizers.b_bytes)


def test_segments_are_freed_as_soon_as_they_are_left(tokenizers):
    gc.disable()
    try:
        known = Segments(tokenizers)
        assert known.number("a b a").tolist() == [0, 1, 0] and list(known.numbers) == ["a", "b"]
        gone = weakref.ref(known)
        del known
        assert gone() is None
    finally:
        gc.enable()


def test_files_of_blocks_hold_few_rows(spark):
    text = "over and over " * (alignment.BLOCK_BYTES // 14 + 1)
    rows = [(n, text) for n in range(alignment.FILE_BLOCKS + 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = os.path.dirname(alignment.fresh_path(spark, "token-blocks"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = align_documents(docs).collect()
    assert {r.doc_id for r in found} == set(range(len(rows))) and len({r[1:] for r in found}) == 1
    (stored,) = [f"{folder}/{name}" for name in os.listdir(folder) if name not in before and name.startswith("token-blocks")]
    assert len([name for name in os.listdir(stored) if name.startswith("part-")]) == 2
    assert sorted(r.block for r in spark.read.parquet(stored).collect()) == list(range(len(rows)))
