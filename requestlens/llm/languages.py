"""Language identification: script ranges, scores per word, and Viterbi spans.

Each word gets a log score per language from its byte trigrams and itself; the script of its letters rules out languages that
do not write in it. Viterbi decoding with a penalty per switch labels spans of words, so a text may mix languages; the
text's language is the one whose spans hold most letters. Model size and work per word are fixed.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from requestlens.llm.inputs import id_remainder, small_batches
from requestlens.llm.words import Words, mix, pieces, split, sums_before

UNKNOWN = "und"
SLOT_BITS = 16
SAMPLE_ROWS = 2_000  # of each language
SAMPLE_BYTES = 40_000  # of each text
PASSAGE_BYTES = 4_000
MOST_HELD = 100
CLIP = 4.0
PENALTY = 12.0
SEED = 13

# Scripts by the words of Unicode names; a word belongs to the script of most of its letters. Letters of all others are "other".
_NAMED = {
    "LATIN": "latin", "FEMININE": "latin", "MASCULINE": "latin", "MICRO": "latin", "CJK": "kana_han", "IDEOGRAPHIC": "kana_han", "HIRAGANA": "kana_han",
    "KATAKANA": "kana_han", "KATAKANA-HIRAGANA": "kana_han",
} | {
    name: name.lower() for name in (
        "GREEK", "CYRILLIC", "HEBREW", "ARABIC", "ARMENIAN", "GEORGIAN", "SYRIAC", "THAANA", "NKO", "TIFINAGH", "ETHIOPIC", "DEVANAGARI", "BENGALI", "GURMUKHI",
        "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "THAI", "LAO", "TIBETAN", "MYANMAR", "KHMER", "HANGUL",
    )
}
SCRIPTS = [*dict.fromkeys(_NAMED.values()), "other"]


@cache
def script_table() -> np.ndarray:
    """The script of each code point that is a letter, -1 for all others."""
    table = np.full(0x110000, -1, dtype=np.int8)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = SCRIPTS.index(next((_NAMED[w] for w in unicodedata.name(c, "").split() if w in _NAMED), "other"))
    return table


def letter_scripts(data: np.ndarray) -> np.ndarray:
    """The script of the letter that begins at each UTF-8 byte, -1 where none does."""
    table = script_table()
    out = np.where(data < 0x80, table[data], np.int8(-1))
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead].astype(np.int32)
    more = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
    two = (first & 0x1F) << 6 | more[0]
    three = (first & 0x0F) << 12 | more[0] << 6 | more[1]
    four = (first & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
    point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    out[lead] = table[np.minimum(point, 0x10FFFF)]
    return out


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each distinct word without case and outer punctuation, and the number of each word among them."""
    start, end = words.bare()
    hashed = words.range_hashes([(start, end)], lower=True)[0]
    found, first, number = np.unique(hashed, return_index=True, return_inverse=True)
    return start[first], end[first], found, number


def features(words: Words, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slots, word of each slot, script of each word or -1, letters of each word) of some words.

    Slots: each byte trigram of a word between two blanks, and the word.
    """
    n = len(start)
    low = words.data.astype(np.uint64)
    low += np.uint64(32) * ((words.data >= 65) & (words.data <= 90))
    length = end - start
    word = np.repeat(np.arange(n), length)
    at = np.repeat(start - sums_before(length)[:-1], length) + np.arange(int(length.sum()))
    before = np.where(at > start[word], low[np.maximum(at - 1, 0)], np.uint64(32))
    after = np.where(at + 1 < end[word], low[np.minimum(at + 1, len(low) - 1)], np.uint64(32))
    shift = np.uint64(64 - SLOT_BITS)
    trigrams = mix(before << np.uint64(16) | low[at] << np.uint64(8) | after) >> shift
    whole = hashed >> shift
    script = letter_scripts(words.data)
    present = np.flatnonzero(np.bincount(script + 1, minlength=len(SCRIPTS) + 1)[1:])
    if len(present) == 0:
        present = np.array([0])
    letters = np.zeros((n, len(present)), dtype=np.int32)
    for i, k in enumerate(present):
        before_k = sums_before((script == k).astype(np.int32))
        letters[:, i] = before_k[end] - before_k[start]
    count = letters.sum(1)
    return (
        np.concatenate([trigrams, whole]).astype(np.int32), np.concatenate([word, np.arange(n)]),
        np.where(count > 0, present[letters.argmax(1)], -1), count,
    )


@dataclass
class Model:
    """Languages, log shares of slots by language, and the scripts of each language."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray

    def emissions(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(score of each word and language, at most 0 and at least -CLIP for languages of its script; letters of each word)."""
        start, end, hashed, number = distinct_words(words)
        slots, word, script, letters = features(words, start, end, hashed)
        n, count = len(start), len(self.languages)
        out = np.stack([np.bincount(word, self.scores[slots, k], n) for k in range(count)], 1) if n else np.zeros((0, count))
        if not n:
            return out, letters
        allowed = np.where((script >= 0)[:, None], self.scripts[np.maximum(script, 0)], True)
        allowed |= ~allowed.any(1)[:, None]
        out[~allowed] = -np.inf
        out = np.maximum(out - out.max(1, keepdims=True), -CLIP)
        out[~allowed] = -4 * CLIP
        out[script < 0] = 0
        return out[number], letters[number]


def count_slots(texts: Iterator[tuple[pa.Array, np.ndarray]], most: int = MOST_HELD) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(language, slot, count) of texts and their languages by number; the letters of script k count at slot 2**SLOT_BITS + k.

    Counts of at most about ``most`` languages are held; the counts of one language may come in several parts.
    """
    size = (1 << SLOT_BITS) + len(SCRIPTS)
    held: dict[int, np.ndarray] = {}

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for code, counts in held.items():
            at = np.flatnonzero(counts)
            yield np.full(len(at), code), at, counts[at]
        held.clear()

    for column, label in texts:
        for row, words in pieces(column):
            start, end, hashed, number = distinct_words(words)
            slots, word, script, letters = features(words, start, end, hashed)
            mine = label[row + words.text_of()]
            known = script >= 0
            for code in np.unique(mine).tolist():
                times = np.bincount(number[mine == code], minlength=len(start))
                if code not in held and len(held) >= most:
                    yield from parts()
                counts = held.setdefault(code, np.zeros(size, dtype=np.int64))
                counts[: 1 << SLOT_BITS] += np.bincount(slots, times[word], 1 << SLOT_BITS).astype(np.int64)
                counts[1 << SLOT_BITS:] += np.bincount(script[known], (times * letters)[known], len(SCRIPTS)).astype(np.int64)
    yield from parts()


def model_of(languages: list[str], parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """Naive Bayes shares with half a count added per slot; a language has the scripts of at least a hundredth of its letters."""
    size = 1 << SLOT_BITS
    scores = np.full((size, len(languages)), 0.5, dtype=np.float32)
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    for code, slot, count in parts:
        is_script = slot >= size
        np.add.at(scripts, (slot[is_script] - size, code[is_script]), count[is_script])
        np.add.at(scores, (slot[~is_script], code[~is_script]), count[~is_script])
    scores /= scores.sum(0, dtype=np.float64)
    return Model(languages, np.log(scores), scripts >= 0.01 * np.maximum(1, scripts.sum(0)))


def learn(languages: list[str], texts: Iterator[tuple[pa.Array, np.ndarray]]) -> Model:
    return model_of(languages, count_slots(texts))


def decode(emission: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word, texts given by the bounds ``first``.

    A path starts free of charge in the language with the best sum over the text; every other start and every switch costs
    the penalty. Where no language leads that one by more than the penalty over any stretch of words, it labels the whole
    text; only other texts need the step by step recursion, which runs over all of them at once.
    """
    n, count = emission.shape
    texts = len(first) - 1
    text = np.repeat(np.arange(texts), np.diff(first))
    path = np.zeros(n, dtype=np.int32)
    if n == 0 or count == 1:
        return path
    totals = np.stack([np.bincount(text, emission[:, k], texts) for k in range(count)], 1)
    best = totals.argmax(1)
    path[:] = best[text]
    lead = emission - emission[np.arange(n), path][:, None]
    far = 8.0 * CLIP * (np.diff(first).max() + 1)
    most = np.zeros(texts)
    filled = np.flatnonzero(np.diff(first) > 0)
    for k in range(count):
        run = np.cumsum(lead[:, k])
        run -= (run[first[:-1][filled]] - lead[first[:-1][filled], k])[np.searchsorted(filled, text)]
        drop = far * text
        floor = np.minimum.accumulate(np.concatenate([[0.0], (run - drop)[:-1]]))
        starts = np.concatenate([[True], text[1:] != text[:-1]])
        floor = np.minimum(np.where(starts, 0.0, floor + drop), 0.0)
        gain = run - floor
        most[filled] = np.maximum(most[filled], np.maximum.reduceat(gain, first[:-1][filled]))
    mixed = np.flatnonzero(most > penalty)
    if len(mixed) == 0:
        return path
    lengths = np.diff(first)[mixed]
    mixed = mixed[np.argsort(-lengths, kind="stable")]
    lengths = np.diff(first)[mixed]
    start = first[:-1][mixed]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    value = np.full((len(mixed), count), -penalty)
    value[np.arange(len(mixed)), best[mixed]] = 0.0
    value += emission[start]
    switched = np.zeros((n, count), dtype=bool)
    source = np.zeros(n, dtype=np.int16)
    for t in range(1, int(lengths[0])):
        a = active[t]
        v, at = value[:a], start[:a] + t
        top = v.argmax(1)
        jump = v[np.arange(a), top] - penalty
        switch = jump[:, None] > v
        value[:a] = np.where(switch, jump[:, None], v) + emission[at]
        switched[at], source[at] = switch, top
    state = value.argmax(1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        path[at] = state[:a]
        if t:
            state[:a] = np.where(switched[at, state[:a]], source[at], state[:a])
    return path


SPANS = "array<struct<lang:string,first_word:int,end_word:int>>"
RESULT = f"struct<lang_pred:string,score:double,spans:{SPANS}>"


MOST_SCORES = 8_000_000


def emitted(model: Model, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the first text, word scores, letters, first word of each text) for runs of texts of at most ``MOST_SCORES`` scores.

    Longer runs cost decoding fewer steps. A longer text is a run of its own.
    """
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    begin = size = 0

    def run() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        counts = np.concatenate([np.diff(first) for _, _, first in held])
        return begin, np.concatenate([e for e, _, _ in held]), np.concatenate([x for _, x, _ in held]), sums_before(counts)

    for row, words in pieces(texts):
        emission, letters = model.emissions(words)
        if held and size + emission.size > MOST_SCORES:
            yield run()
            held, begin, size = [], row, 0
        held.append((emission, letters, words.first))
        size += emission.size
    if held:
        yield run()


def label_texts(model: Model, texts: pa.Array) -> pa.Array:
    """Struct of language, score and spans for each text."""
    langs, scores, bounds, span_lang, span_from, span_to = [], [], [0], [], [], []
    names = np.array(model.languages, dtype=object)
    for _, emission, letters, first in emitted(model, texts):
        n, count = len(first) - 1, len(names)
        path = decode(emission, first)
        text = np.repeat(np.arange(n), np.diff(first))
        held = np.bincount(text * count + path, letters, n * count).reshape(n, count)
        # Languages in ascending order: the first of equal ones wins.
        best = held.argmax(1)
        odds = np.exp(emission)
        agree = np.bincount(text, letters * odds[np.arange(len(path)), best[text]] / odds.sum(1), n) if len(path) else np.zeros(n)
        total = held.sum(1)
        score = agree / np.maximum(total, 1)
        opens = np.ones(len(path), dtype=bool)
        opens[1:] = (path[1:] != path[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(opens)
        span_lang.append(path[at])
        span_from.append(at - first[text[at]])
        ends = np.append(at[1:], len(path))[: len(at)]
        span_to.append(ends - first[text[at]])
        per_text = np.bincount(text[at], minlength=n)
        for i in range(n):
            if total[i] == 0:
                langs.append(UNKNOWN)
                scores.append(0.0)
            else:
                langs.append(names[best[i]])
                scores.append(float(min(1.0, max(0.0, score[i]))))
            bounds.append(bounds[-1] + int(per_text[i]))
    joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (span_lang, span_from, span_to)]
    fields = [pa.array(names[joined[0].astype(np.int64)], pa.string()), pa.array(joined[1], pa.int32()), pa.array(joined[2], pa.int32())]
    spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, ["lang", "first_word", "end_word"]))
    return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), spans], ["lang_pred", "score", "spans"])


def passages_of(text: str, most: int = SAMPLE_BYTES) -> str:
    """The text, or whole word passages of at most ``most`` bytes in all, chosen by a hash and in their order.

    Words that begin in the same ``PASSAGE_BYTES`` bytes are a passage. Where no passage is short enough, the first chosen one is cut.
    """
    raw = text.encode()
    if len(raw) <= most:
        return text
    data = np.frombuffer(raw, np.uint8)
    words = split(data, np.array([0, len(data)]))
    if len(words.start) == 0:
        return ""
    block = words.start // PASSAGE_BYTES
    at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    start, end = words.start[at], words.end[np.append(at[1:], len(block)) - 1]
    order = np.argsort(mix(block[at].astype(np.uint64) + np.uint64(zlib.crc32(raw[:PASSAGE_BYTES])) + np.uint64(1)), kind="stable")
    taken, left = [], most
    for i in order.tolist():
        size = int(end[i] - start[i]) + 1
        if size <= left:
            taken.append(i)
            left -= size
    if not taken:
        return raw[start[order[0]]: start[order[0]] + most].decode(errors="ignore")
    return " ".join(raw[start[i]: end[i]].decode() for i in sorted(taken))


def fit_languages(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from at most ``rows`` texts of each language, drawn by a hash of the ids; None where no text can be learned from.

    Learns only from documents whose crc32(doc_id as text) mod 3 is not 1, with a language, a text and an id, and learns
    every language of such a document. Of a text above ``SAMPLE_BYTES`` bytes it learns from passages.
    """
    drawn_by = Window.partitionBy("lang").orderBy("_share", "doc_id")
    fit = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder(F.col("doc_id"), 3) != 1)
    )
    sizes = [(r["lang"], r["_n"]) for r in fit.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("_n")).collect()]
    languages = sorted(lang for lang, _ in sizes)
    if not languages:
        return None
    # Of a frequent language only the ids of small hashes are ranked, about four times as many as are drawn.
    share = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sized = docs.sparkSession.createDataFrame(sizes, "lang string, _n long")
    drawn = fit.join(F.broadcast(sized), "lang").where(share * F.col("_n") < 4 * rows).select("doc_id", "lang", share.alias("_share")).distinct()
    drawn = drawn.withColumn("_place", F.row_number().over(drawn_by)).where(F.col("_place") <= rows).select("doc_id", "lang")

    @F.arrow_udf("string")
    def passages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([passages_of(t) for t in texts.to_pylist()], pa.string())

    # One text of each drawn id and language, so repeated rows add nothing.
    chosen = fit.join(F.broadcast(drawn), ["doc_id", "lang"]).select("doc_id", "lang", passages(F.col("text")).alias("text"))
    sample = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    number = {code: i for i, code in enumerate(languages)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((b.column("text"), np.array([number[code] for code in b.column("lang").to_pylist()], dtype=np.int64)) for b in batches if b.num_rows)
        for code, slot, count in count_slots(texts):
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(slot, pa.int32()), pa.array(count, pa.int64())], ["code", "slot", "n"])

    # Texts are counted in tasks; the driver receives the summed counts, which are as many as the model has at most.
    counts = sample.select("lang", "text").mapInArrow(counted, "code int, slot int, n long").groupBy("code", "slot").agg(F.sum("n").alias("n")).toArrow()
    return model_of(languages, ((b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in counts.to_batches()))


def identify_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, spans.

    ``held_out``: crc32(doc_id as text) mod 3 is 1; a null id is not held out, and never learned from. ``lang_pred`` is ``und``, with
    score 0, for a null text or one without a letter, and for every text where nothing can be learned. ``score`` is
    the mean share of the predicted language in the scores of the letters' words. ``spans`` covers all words of a text
    by ranges of one language, end exclusive. Repeated rows are labelled alike. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    model = fit_languages(docs)
    held_out = (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out")

    @F.arrow_udf(RESULT)
    def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield label_texts(model, texts)

    if model is None:
        found = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.expr(f"cast(array() as {SPANS})").alias("spans"))
    else:
        found = labelled(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, found.alias("_found")).select("doc_id", "held_out", "_found.*")
