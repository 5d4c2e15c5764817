"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its distinct words without case and outer punctuation, and their first four and five bytes, hashed
to a fixed number of slots. The score adds a weight per term and, for every pair of terms, the inner product of their
factors, so two terms that matter only together can raise it. The model is fitted on a bounded sample of labelled texts,
holds every slot seen there and has a size bound by the number of slots; scoring reads each text once, where it lies, without a shuffle.
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
from requestlens.llm.words import pieces

SLOT_BITS = 18
FACTORS = 8
SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 40_000
EPOCHS = 12
SEED = 7
WEIGHT_RATE, FACTOR_RATE = 0.0375, 0.0125
WEIGHT_PENALTY, FACTOR_PENALTY = 1.0, 100.0  # of a slot, over all its texts
HALF_Z, SCALE_FLOOR, HALF_TEXTS = 4.0, 0.02, 100.0


def terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, slots, first slot of each text and the end) for pieces of a text column."""
    for row, words in pieces(texts):
        start, end = words.bare()
        hashed = words.range_hashes([(start, end), (start, np.minimum(start + 4, end)), (start, np.minimum(start + 5, end))], lower=True)
        shift = np.uint64(64 - SLOT_BITS)
        salted = [(h * np.uint64(2 * i + 1)) >> shift for i, h in enumerate(hashed)]
        text = words.text_of().astype(np.uint64) << np.uint64(SLOT_BITS)
        keys = np.sort(np.concatenate([text | s for s in salted]))
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]
        n = len(words.first) - 1
        yield row, (keys & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int32), np.searchsorted(keys >> np.uint64(SLOT_BITS), np.arange(n + 1, dtype=np.uint64))


@dataclass
class Machine:
    """A bias, and a weight and factors for each slot of the sample; ``place`` gives their row for a slot, or -1."""

    bias: float
    place: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row = self.place[slots]
        known = row >= 0
        n = len(bounds) - 1
        text = np.repeat(np.arange(n), np.diff(bounds))[known]
        row = row[known]
        alone = self.weights - 0.5 * (self.factors**2).sum(1)
        raw = self.bias + np.bincount(text, alone[row], n)
        for column in self.factors.T:
            raw += 0.5 * np.bincount(text, column[row], n) ** 2
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def scales(having: np.ndarray, toxic: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the weight and the factors of slots may move, from the numbers of texts, and of toxic ones, that have them.

    Weights follow the z-score of the toxic share and stay above a floor. Factors follow the number of texts alone, since terms
    that matter only together need not differ alone.
    """
    n, share = len(labels), labels.mean()
    z2 = (toxic - having * share) ** 2 / ((having + 1) * share * (1 - share) * (1 - having / (n + 1)))
    return np.maximum(SCALE_FLOOR, z2 / (z2 + HALF_Z**2)), having / (having + HALF_TEXTS)


def fit(chunks: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> Machine:
    """Adagrad on the logistic loss, in small batches, over all slots of chunks of texts; the classes weigh the same.

    Rare slots and those without evidence are shrunk: by their scales, and by a penalty fixed per slot, thus larger for each text
    of a rare one. Without both classes the machine has the share of label 1 as its only, constant score.
    """
    rng = np.random.default_rng(seed)
    n, positives = len(labels), int(labels.sum())
    size = 1 << SLOT_BITS
    place = np.full(size, -1, dtype=np.int32)
    if positives in (0, n):
        share = (positives + 0.5) / (n + 1)
        return Machine(float(np.log(share / (1 - share))) if n else 0.0, place, np.empty(0), np.empty((0, FACTORS)))
    having, toxic, at = np.zeros(size), np.zeros(size), 0
    for slots, bounds in chunks:
        having += np.bincount(slots, minlength=size)
        toxic += np.bincount(slots, np.repeat(labels[at: at + len(bounds) - 1], np.diff(bounds)), size)
        at += len(bounds) - 1
    seen = np.flatnonzero(having)
    place[seen] = np.arange(len(seen))
    having = having[seen]
    weight_scale, factor_scale = scales(having, toxic[seen], labels)
    texts = [slots[a:b] for slots, bounds in chunks for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    # Weights and factors before they are scaled.
    weights, factors = np.zeros(len(seen)), rng.normal(0, 0.05, (FACTORS, len(seen)))
    class_weight = np.where(labels == 1, n / (2 * positives), n / (2 * (n - positives)))
    bias, g_bias = 0.0, 1.0
    g_weights, g_factors = np.ones(len(seen)), np.ones((FACTORS, len(seen)))
    number = np.empty(len(seen), dtype=np.int64)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(n), max(1, n // 64)):
            m = len(batch)
            slots = place[np.concatenate([texts[i] for i in batch])]
            row = np.repeat(np.arange(m), [len(texts[i]) for i in batch])
            texts_with = np.bincount(slots, minlength=len(seen))
            used = np.flatnonzero(texts_with)
            number[used] = np.arange(len(used))
            where = number[slots]
            part = texts_with[used] / having[used]
            a, b = weight_scale[used], factor_scale[used]
            held = factors[:, used]
            v = held * b
            total = np.stack([np.bincount(row, column[where], m) for column in v])
            alone = weights[used] * a - 0.5 * (v * v).sum(0)
            raw = bias + np.bincount(row, alone[where], m) + 0.5 * (total**2).sum(0)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[batch]) * class_weight[batch]
            pull = np.bincount(where, error[row], len(used))
            step = pull * a + WEIGHT_PENALTY * part * weights[used]
            g_weights[used] += step**2
            weights[used] -= WEIGHT_RATE * step / np.sqrt(g_weights[used])
            move = np.stack([np.bincount(where, column[row], len(used)) for column in error * total]) - pull * v
            move = move * b + FACTOR_PENALTY * part * held
            past = g_factors[:, used] + move**2
            g_factors[:, used] = past
            factors[:, used] = held - FACTOR_RATE * move / np.sqrt(past)
            g = error.sum()
            g_bias += g**2
            bias -= WEIGHT_RATE * g / np.sqrt(g_bias)
    return Machine(float(bias), place, (weights * weight_scale).astype(np.float32), (factors * factor_scale).T.astype(np.float32))


def fit_sample(sample: pa.Table) -> Machine:
    """A machine fitted on a table of texts and labels."""
    chunks = [(slots, bounds) for batch in sample.to_batches() for _, slots, bounds in terms(batch.column(0))]
    return fit(chunks, sample.column(1).to_numpy().astype(np.int64))


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted on at most ``rows`` labelled texts, of long ones on passages of at most ``SAMPLE_BYTES`` bytes in all."""
    return fitted(labelled_texts(docs, labels, "toxic", learn, rows, SAMPLE_BYTES, SEED), fit_sample)


def toxicity(text: Column, machine: Machine) -> Column:
    """Score between 0 and 1 of a text column; a null text scores like an empty one, by the bias alone."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [machine.score(slots, bounds) for _, slots, bounds in terms(texts)]
            yield pa.array(np.concatenate([np.empty(0), *parts]), pa.float64())

    return scored(text)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labels of documents whose crc32(doc_id as text) mod 5 is not 0; the others are held out. A null id is held
    out. ``predicted`` is 1 from a score of 0.5. Repeated rows score alike. Without usable labels all texts score 0.5.
    An empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    machine = fit_toxicity(docs, labels, ~held_out)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), toxicity(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below 0.5, with all their columns; all of them where the labels do not show both classes.

    Null and empty texts score by the bias alone, repeated rows alike. Ids matter to the choice of the labels learned from only; documents
    with a null id are scored like others. An empty table gives no rows; other columns are passed on unread.
    """
    small_batches(docs.sparkSession)
    machine = fit_toxicity(docs, labels, id_remainder(F.col("doc_id"), 5) != 0)
    return docs.where(toxicity(F.col("text"), machine) < 0.5) if len(machine.weights) else docs
