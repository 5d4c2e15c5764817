"""Two tokenizers over the same text, and how their tokens meet: the work on texts inside a task.

A text is cut where a single space stands between two characters that are not white space. Neither tokenizer has a token across
such a place, whatever stands beside it: the pattern that precedes byte pairs starts a match there, and no piece has
a space after another character. So each distinct segment is tokenized once, with the space before it, and a text is
the sequence of its segments. The cut is checked against whole texts in the tests, and left out for texts that the
second tokenizer changes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_ALONE = re.compile(r"(?<=\S) (?=\S)")
_CROWDED = re.compile(r"\s\s|^\s|\s\Z")
_SPACE = "▁"
_NONE = np.empty(0, np.int64)
_TOGETHER = 1 << 16
_BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


def _decoded_pieces(model) -> list[bytes]:
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = _BYTE.match(piece)
        found.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode())
    return found


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def segments(text: str) -> list[str]:
    """The text cut at lone spaces, which are left out; each segment is tokenized with a space before it."""
    return _ALONE.split(text) if _CROWDED.search(text) else text.split(" ")


def runs(text: str, most: int = 1 << 20) -> Iterator[str]:
    """The text in runs of about ``most`` characters, cut at lone spaces, so that a long text is never cut up as a whole."""
    while len(text) > most and (cut := _ALONE.search(text, most)):
        yield text[: cut.start()]
        text = text[cut.end():]
    yield text


@dataclass
class Spans:
    """Tokens one after the other: ids, and the byte where each ends; ``exact``: together they have the bytes of the text."""

    ids: np.ndarray
    end: np.ndarray
    exact: bool


def cut_ends(sizes: np.ndarray, span_start: np.ndarray, span_end: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """The byte where each token of a text ends.

    A character span gives it where the next token's span starts no earlier: a coarse cut. Tokens that share a character,
    or whose span is empty, lie between two coarse cuts; their ends follow from the sizes of their decoded bytes.
    """
    if not len(sizes):
        return np.empty(0, np.int64)
    coarse = (span_end > span_start) & np.append(span_end[:-1] <= span_start[1:], True)
    ends = byte_at[span_end]
    counted = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(coarse, np.arange(len(sizes)), -1))
    known = np.where(last >= 0, ends[last] - counted[last], 0)
    return np.where(coarse, ends, known + counted)


class Tokenizers:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, folder: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        path = os.path.join(folder, BYTE_TOKENIZER)
        self.byte_level = Tokenizer.from_file(path)
        self.byte_level.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECE_TOKENIZER))
        letters = _byte_letters()
        with open(path, encoding="utf-8") as source:
            entries = json.load(source)["model"]["vocab"]
        self.a_bytes = [b""] * self.byte_level.get_vocab_size()
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(map(letters.__getitem__, entry))
        self.b_bytes = _decoded_pieces(self.pieces)
        self.a_names, self.b_names = list(map(str, range(len(self.a_bytes)))), list(map(str, range(len(self.b_bytes))))
        self.a_size = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), np.int64)

    def _spans(self, whole: bytes, ids: Sequence[int], spans: Sequence[tuple[int, int]], entries: list[bytes], size: np.ndarray, shift: int) -> Spans:
        flat = np.array(ids, np.int64)
        if b"".join(map(entries.__getitem__, ids)) != whole:
            return Spans(flat, np.full(len(flat), len(whole)), False)
        data = np.frombuffer(whole, np.uint8)
        byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(whole))
        span = np.array(spans, np.int64).reshape(-1, 2) + shift
        found, counted = cut_ends(size[flat], span[:, 0], span[:, 1], byte_at), np.cumsum(size[flat])
        # A library that reports another span than its token's bytes does not move a token.
        return Spans(flat, found if np.array_equal(found, counted) else counted, True)

    def encode(self, text: str) -> tuple[bytes, Spans, Spans]:
        """A text with a space before it as bytes; its tokens of the byte-level tokenizer, and of the piece tokenizer, which adds the space."""
        whole = b" " + text.encode()
        a = self.byte_level.encode(" " + text, add_special_tokens=False)
        b = self.pieces.encode(text, return_type="offset_mapping")
        return whole, self._spans(whole, a.ids, a.offsets, self.a_bytes, self.a_size, 0), self._spans(whole, b["ids"], b["offsets"], self.b_bytes, self.b_size, 1)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, Spans, Spans, np.ndarray]:
        """Many segments: their ends in bytes one after the other, the tokens of both kinds over all of them, and which are exact.

        Segments that start and end without white space are joined by single spaces and tokenized together; where that does
        not give back their bytes, and for all others, each segment is tokenized alone.
        """
        stop, left, right, exact = [np.zeros(1, np.int64)], [], [], []
        base = 0

        def add(some: list[str]) -> None:
            nonlocal base
            whole, a, b = self.encode(" ".join(some))
            if len(some) > 1 and not (a.exact and b.exact):
                for text in some:
                    add([text])
                return
            stop.append(base + np.cumsum([len(text.encode()) + 1 for text in some]))
            left.append(Spans(a.ids, a.end + base, a.exact))
            right.append(Spans(b.ids, b.end + base, b.exact))
            exact.append(np.full(len(some), a.exact and b.exact and bool(some[0])))
            base += len(whole)

        together: list[str] = []
        size = 0
        for text in texts:
            alone = not text or text[0].isspace() or text[-1].isspace() or _SPACE in text
            if together and (alone or size + len(text) > _TOGETHER):
                add(together)
                together, size = [], 0
            if alone:
                add([text])
            else:
                together.append(text)
                size += len(text) + 1
        if together:
            add(together)
        a, b = (Spans(np.concatenate([_NONE, *(s.ids for s in side)]), np.concatenate([_NONE, *(s.end for s in side)]), True) for side in (left, right))
        return np.concatenate(stop), a, b, np.concatenate([np.empty(0, bool), *exact])


@dataclass
class Aligned:
    """Texts one by one: whether both tokenizers give back the bytes, numbers of tokens and groups, groups as text, links.

    The links of text i are pairs[first[i]:first[i + 1]], each an id of A times 2**32 plus an id of B.
    """

    exact: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    first: np.ndarray


def align(tokenizers: Tokenizers, texts: list[str]) -> Aligned:
    """The texts that differ in bytes from their tokens have no tokens, groups and links here."""
    stop, a, b, exact = tokenizers.encode_all(texts)
    text_a, text_b = np.searchsorted(stop, a.end) - 1, np.searchsorted(stop, b.end) - 1
    a_ids, a_end, text_a = (part[exact[text_a]] for part in (a.ids, a.end, text_a))
    b_ids, b_end, text_b = (part[exact[text_b]] for part in (b.ids, b.end, text_b))
    # Between two neighbouring ends of either kind, one token of A overlaps one of B; each such stretch is another pair.
    every = np.sort(np.concatenate([a_end, b_end]), kind="stable")
    twice = every[1:] == every[:-1]
    ends, common = every[np.append(True, ~twice)[: len(every)]], every[1:][twice]
    at_a, at_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
    pairs = (a_ids[at_a] << 32) | b_ids[at_b]
    of_text = np.searchsorted(stop, common, "left") - 1
    after_a, after_b = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
    names_a = list(map(tokenizers.a_names.__getitem__, a_ids.tolist()))
    names_b = list(map(tokenizers.b_names.__getitem__, b_ids.tolist()))
    groups, from_a, from_b = [], 0, 0
    for to_a, to_b in zip(after_a.tolist(), after_b.tolist()):
        one_a = names_a[from_a] if to_a - from_a == 1 else ",".join(names_a[from_a:to_a])
        one_b = names_b[from_b] if to_b - from_b == 1 else ",".join(names_b[from_b:to_b])
        groups.append(f"{one_a}|{one_b}")
        from_a, from_b = to_a, to_b
    n_groups = np.bincount(of_text, minlength=len(texts))
    bounds = np.cumsum([0, *n_groups.tolist()]).tolist()
    return Aligned(
        exact, np.bincount(text_a, minlength=len(texts)), np.bincount(text_b, minlength=len(texts)), n_groups,
        [";".join(groups[low:high]) for low, high in zip(bounds, bounds[1:])],
        pairs, np.searchsorted(ends, stop, "right"),
    )


class Numbers(dict):
    """Texts numbered in the order in which they are looked up. It refers to nothing else, so it is freed as soon as it is left."""

    def __missing__(self, text: str) -> int:
        self[text] = number = len(self)
        return number


class Segments:
    """Aligned segments by number, each worked out once until ``most`` of them are held."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self.numbers = Numbers()
        self.done = 0
        self.held = 0
        self.exact = np.empty(0, bool)
        self.counts = np.empty((0, 4), np.int64)
        self.groups: list[str] = []
        self.pairs = np.empty(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def number(self, text: str) -> np.ndarray:
        cuts = (np.fromiter(map(self.numbers.__getitem__, cut), np.int64, len(cut)) for cut in map(segments, runs(text)))
        return np.concatenate(list(cuts))

    def number_whole(self, text: str) -> np.ndarray:
        """The whole text as one segment."""
        return np.array([self.numbers[text]], np.int64)

    def work_out(self, batch_chars: int = 1 << 20) -> None:
        """Align the segments numbered since the last call, some characters at a time."""
        fresh = list(self.numbers)[self.done:]
        low = 0
        parts = []
        while low < len(fresh):
            high, size = low, 0
            while high < len(fresh) and (high == low or size + len(fresh[high]) <= batch_chars):
                size += len(fresh[high]) + 1
                high += 1
            parts.append(align(self.tokenizers, fresh[low:high]))
            low = high
        if parts:
            self.exact = np.concatenate([self.exact, *(p.exact for p in parts)])
            counts = [np.stack([p.n_a, p.n_b, p.n_groups, np.diff(p.first)], axis=1) for p in parts]
            self.counts = np.concatenate([self.counts, *counts])
            for p in parts:
                self.groups += p.groups
            self.pairs = np.concatenate([self.pairs, *(p.pairs for p in parts)])
            self.first = np.concatenate([[0], np.cumsum(self.counts[:, 3])])
        self.done = len(self.numbers)
