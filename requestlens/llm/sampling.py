"""Bounded samples of labelled texts, on which the classifiers are fitted."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestlens.llm.languages import passages_of

TOTAL_BYTES = 96 << 20


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, most_bytes: int, seed: int, total_bytes: int = TOTAL_BYTES
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents for which ``learn``, a condition on doc_id, holds.

    The sample follows a hash of the ids. Ids are drawn from the labels first, so at most ``rows`` of them meet the
    documents, which are neither shuffled nor sorted as a whole. Of a text above ``most_bytes`` the sample has whole passages
    of as many bytes, chosen by a hash. It ends with the text that brings it to ``total_bytes``, whatever the lengths of those
    after it. A document with contradictory labels counts as 1; null ids and labels are left out.
    """
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1))
        .where(learn)
        .groupBy("doc_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(rows)
    )

    @F.arrow_udf("string")
    def shortened(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([passages_of(t, most_bytes) for t in texts.to_pylist()], pa.string())

    order = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id"), F.xxhash64("_text")]
    # Rows of the sample only: as many texts of as many bytes as the bounds allow.
    before = Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(F.broadcast(drawn), "doc_id")
        .withColumn("_text", shortened("_text"))
        .select("_text", "_label", F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)]).alias("_order"))
        .orderBy("_order")
        .limit(rows)
        .withColumn("_bytes_before", F.coalesce(F.sum(F.octet_length("_text").cast("long")).over(before), F.lit(0)))
        .where(F.col("_bytes_before") < total_bytes)
        .select("_text", "_label")
    )


Model = TypeVar("Model")
_SAMPLE = pa.schema([("_text", pa.string()), ("_label", pa.int32())])


def fitted(sample: DataFrame, fit: Callable[[pa.Table], Model]) -> Model:
    """The model that ``fit`` makes of a bounded sample, in one task; the driver receives the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.cast(_SAMPLE) for b in batches], _SAMPLE)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit(table))]})

    rows = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else fit(_SAMPLE.empty_table())
