"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. Every passage is described by its typography and repetition and by the sum of learned
embeddings of its words, hashed to a fixed number of slots, and encoded. Gated attention, learned from the labels of whole documents, weighs the encoded passages; the score is a logistic function
of the weighted mean. The model is small and of fixed size; scoring reads each text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestlens.llm.inputs import id_remainder, small_batches
from requestlens.llm.sampling import fitted, labelled_texts
from requestlens.llm.words import Words, pieces, sums_before

PASSAGE_WORDS = 64
HIDDEN = 16
FEATURES = 16
SLOT_BITS = 14
EMBEDDED = 8
WORD_DECAY = 10.0  # of embeddings, a step and unit of the learning rate; words without evidence return to none
SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 40_000
EPOCHS = 30
SEED = 11
RATE = 0.005

_UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _WIDE = range(6)
_CLASS = np.zeros((256, 6), dtype=np.int32)
_CLASS[ord("A"):ord("Z") + 1, _UPPER] = 1
_CLASS[ord("a"):ord("z") + 1, _LOWER] = 1
_CLASS[ord("0"):ord("9") + 1, _DIGIT] = 1
_CLASS[[ord(c) for c in ".,;:!?'\"()-"], _MARK] = 1
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"], _SYMBOL] = 1
_CLASS[128:, _WIDE] = 1


@dataclass
class Passages:
    """Features of each passage, the first passage of each text and the end; slots of words, and the words' number per passage."""

    features: np.ndarray
    first: np.ndarray
    slots: np.ndarray
    size: np.ndarray

    def take(self, texts: np.ndarray) -> Passages:
        """The passages of some texts, in their order."""
        rows, first = _ranges(self.first, texts)
        words, _ = _ranges(sums_before(self.size), rows)
        return Passages(self.features[rows], first, self.slots[words], self.size[rows])


def _ranges(first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all members of the chosen groups, and the first of each group and the end among them."""
    bounds = sums_before(np.diff(first)[chosen])
    return np.repeat(first[:-1][chosen] - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1]), bounds


def passages(words: Words) -> Passages:
    """The passages of texts; a text without words is one passage of zeros."""
    counts = words.counts
    per_text = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = sums_before(per_text)
    n, total = len(words.start), int(first[-1])
    out = np.zeros((total, FEATURES))
    if n == 0:
        return Passages(out, first, np.empty(0, np.int32), np.zeros(total, np.int64))
    text = words.text_of()
    at = first[text] + (np.arange(n) - words.first[text]) // PASSAGE_WORDS
    size = np.bincount(at, minlength=total)
    safe = np.maximum(size, 1)
    length = (words.end - words.start).astype(float)
    letters = np.maximum(np.bincount(at, length, total), 1)
    opens = np.concatenate([[True], at[1:] != at[:-1]])
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], n) - 1
    for k in range(6):
        before = sums_before(_CLASS[words.data, k])
        out[at[heads], k] = (before[words.end[tails]] - before[words.start[heads]]) / letters[at[heads]]
    hashed = words.hashes()
    out[:, 6] = np.bincount(at, length, total) / safe / 10
    out[:, 7] = np.sqrt(np.maximum(0, np.bincount(at, length**2, total) / safe - (10 * out[:, 6]) ** 2)) / 10
    order = np.lexsort((hashed, at))
    again = (hashed[order][1:] == hashed[order][:-1]) & (at[order][1:] == at[order][:-1])
    out[:, 8] = np.bincount(at[order][1:][again], minlength=total) / safe
    same = np.zeros(n)
    same[1:] = (hashed[1:] == hashed[:-1]) & ~opens[1:]
    out[:, 9] = np.bincount(at, same, total) / safe
    short = length <= 2
    out[:, 10] = np.bincount(at, short, total) / safe
    ends = words.data[words.end - 1]
    out[:, 11] = np.bincount(at, (ends == ord(".")) | (ends == ord("!")) | (ends == ord("?")), total) / safe
    begins = words.data[words.start]
    out[:, 12] = np.bincount(at, (begins >= ord("A")) & (begins <= ord("Z")), total) / safe
    out[:, 13] = np.bincount(at, _CLASS[ends, _SYMBOL], total) / safe
    lines = sums_before((words.data == 10).astype(np.int32))
    out[at[heads], 14] = (lines[words.end[tails]] - lines[words.start[heads]]) / safe[at[heads]]
    out[:, 15] = size / PASSAGE_WORDS
    bare = words.range_hashes([words.bare()], lower=True)[0]
    return Passages(out, first, (bare >> np.uint64(64 - SLOT_BITS)).astype(np.int32), size)


@dataclass
class Bags:
    """A gated-attention network: embeddings e, encoder (a, b), gates (v, u, w), output (c, d), after scaling features by (mean, spread)."""

    mean: np.ndarray
    spread: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, bags: Passages) -> dict[str, np.ndarray]:
        p, first = self.parts, bags.first
        filled, starts = bags.size > 0, sums_before(bags.size)[:-1]
        embedded = np.zeros((len(bags.size), EMBEDDED))
        if filled.any():
            embedded[filled] = np.add.reduceat(p["e"][bags.slots], starts[filled], axis=0) / np.sqrt(bags.size[filled])[:, None]
        x = np.concatenate([np.clip((bags.features - self.mean) / self.spread, -6, 6), embedded], axis=1)
        h = np.tanh(x @ p["a"] + p["b"])
        v, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        raw = np.clip((v * u) @ p["w"], -30, 30)
        top = np.maximum.reduceat(raw, first[:-1])
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        weight = np.exp(raw - top[bag])
        weight /= np.bincount(bag, weight)[bag]
        z = np.add.reduceat(weight[:, None] * h, first[:-1], axis=0)
        logit = np.clip(z @ p["c"] + p["d"][0], -40, 40)
        return {"x": x, "h": h, "v": v, "u": u, "bag": bag, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-logit))}

    def score(self, bags: Passages) -> np.ndarray:
        return self.forward(bags)["score"] if len(bags.first) > 1 else np.empty(0)

    def slopes(self, bags: Passages, error: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of a loss by all parts, from its slopes by the logits of the texts."""
        p, f = self.parts, self.forward(bags)
        bag, weight, h, v, u = f["bag"], f["weight"], f["h"], f["v"], f["u"]
        to_z = error[:, None] * p["c"]
        to_h = weight[:, None] * to_z[bag]
        pull = (h * to_z[bag]).sum(1)
        to_raw = weight * (pull - np.bincount(bag, weight * pull)[bag])
        to_v, to_u = to_raw[:, None] * p["w"] * u * (1 - v * v), to_raw[:, None] * p["w"] * v * u * (1 - u)
        to_h += to_v @ p["v"].T + to_u @ p["u"].T
        to_a = to_h * (1 - h * h)
        to_words = np.repeat((to_a @ p["a"][FEATURES:].T) / np.sqrt(np.maximum(bags.size, 1))[:, None], bags.size, axis=0)
        return {
            "e": np.stack([np.bincount(bags.slots, column, len(p["e"])) for column in to_words.T], axis=1),
            "a": f["x"].T @ to_a, "b": to_a.sum(0), "v": h.T @ to_v, "u": h.T @ to_u, "w": (v * u).T @ to_raw,
            "c": f["z"].T @ error, "d": np.array([error.sum()]),
        }


def fit(bags: Passages, labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> Bags:
    """Adam on the logistic loss over whole bags; the classes weigh the same.

    Embeddings begin at zero and decay, so words without evidence, or unseen, add nothing. Without both classes the network has the share
    of label 1 as its only, constant score.
    """
    rng = np.random.default_rng(seed)
    n = len(labels)
    parts = {
        "e": np.zeros((1 << SLOT_BITS, EMBEDDED)), "a": rng.normal(0, 0.3, (FEATURES + EMBEDDED, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, 0.3, (HIDDEN, HIDDEN)),
        "u": rng.normal(0, 0.3, (HIDDEN, HIDDEN)), "w": rng.normal(0, 0.3, HIDDEN), "c": np.zeros(HIDDEN), "d": np.zeros(1),
    }
    positives = int(labels.sum())
    if positives in (0, n):
        share = (positives + 0.5) / (n + 1)
        parts["d"][0] = np.log(share / (1 - share)) if n else 0.0
        return Bags(np.zeros(FEATURES), np.ones(FEATURES), parts)
    net = Bags(bags.features.mean(0), bags.features.std(0) + 1e-6, parts)
    class_weight = np.where(labels == 1, n / (2 * positives), n / (2 * (n - positives)))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in parts.items()}
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(n), max(1, n // 64)):
            some = bags.take(batch)
            error = (net.score(some) - labels[batch]) * class_weight[batch] / len(batch)
            step += 1
            for name, g in net.slopes(some, error).items():
                m, s = moments[name]
                if name == "e":
                    parts[name] *= 1 - RATE * WORD_DECAY
                else:
                    g = g + 1e-4 * parts[name]
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                parts[name] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def bags_of(texts: pa.Array) -> Iterator[Passages]:
    for _, words in pieces(texts):
        yield passages(words)


def fit_sample(sample: pa.Table) -> Bags:
    """A network fitted on a table of texts and labels."""
    parts = [Passages(np.empty((0, FEATURES)), np.zeros(1, np.int64), np.empty(0, np.int32), np.empty(0, np.int64))]
    parts += [bags for batch in sample.to_batches() for bags in bags_of(batch.column(0))]
    first = sums_before(np.concatenate([np.diff(p.first) for p in parts]))
    whole = Passages(np.concatenate([p.features for p in parts]), first, np.concatenate([p.slots for p in parts]), np.concatenate([p.size for p in parts]))
    return fit(whole, sample.column(1).to_numpy().astype(np.int64))


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Bags:
    """A network fitted on at most ``rows`` labelled texts, of long ones on passages of at most ``SAMPLE_BYTES`` bytes in all."""
    return fitted(labelled_texts(docs, labels, "quality", learn, rows, SAMPLE_BYTES, SEED), fit_sample)


def quality(text: Column, net: Bags) -> Column:
    """Score between 0 and 1 of a text column; a null text scores like an empty one."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.concatenate([np.empty(0), *[net.score(bags) for bags in bags_of(texts)]]), pa.float64())

    return scored(text)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labels of documents whose crc32(doc_id as text) mod 3 is not 1; the others are held out. ``predicted`` is 1
    from a score of 0.5. A text without words is one passage of zeros. Repeated rows score alike. Without usable labels all
    texts score 0.5. An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    net = fit_quality(docs, labels, ~held_out)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), quality(F.col("text"), net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
