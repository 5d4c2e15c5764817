"""The pipeline's stages against brute force on their own inputs, the entry point, and the registered queries against their SQL."""

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from requestlens.llm import mixing, toxicity
from requestlens.llm import queries as llm
from tests.llm.rows import awkward, labels, nothing
from tests.llm.test_duplicates import expected_links, similar_windows
from tests.llm.test_native import expected_shards
from tests.oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in llm.QUERIES} and set(llm.QUERIES) <= names
    assert "pipeline" in names and set(llm.ORACLES) <= set(__spark_entry__.oracle_sql()) and "daily_agency_metrics" in names


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_against_its_sql(spark, name):
    rows, problems = differences(spark, connect(FOLDER), FOLDER, name, llm.QUERIES, llm.ORACLES)
    assert not problems and rows == len(llm.QUERIES[name](spark, FOLDER).collect()) and rows > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(corpus_pipeline.store(stage(spark, tables[-1], FOLDER), "stage"))
    given, clean, single, safe, mixed, sharded = ([tuple(r) for r in t.collect()] for t in tables)
    delivered = tables[-1].select(docs.columns).collect()
    assert Counter(tuple(r) for r in delivered) == Counter(mixed)
    assert all(t.columns == docs.columns for t in tables[:-1])
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, truth).collect()}
    assert {r[0] for r in clean} == {i for i, s in scores.items() if s < 0.5}
    assert {r[0] for r in single} == {i for i, _, c, _ in expected_links([r[:2] for r in clean]) if i == c}
    found = {r[0]: similar_windows(items, r[1]) for r in single}
    kept = {r[0] for r in safe}
    assert kept >= {i for i, f in found.items() if not f} and not any(items_text in r[1] for r in safe for _, items_text in items)
    taken = {r.doc_id: r for r in mixing.mix_sources(tables[3]).collect()}
    assert Counter(r[0] for r in mixed) == {i: len(r.draws) for i, r in taken.items() if len(r.draws)}
    assert sorted([r[:3] + r[4:6] for r in sharded], key=str) == expected_shards([r[:2] for r in mixed], 24)


def test_run(spark):
    first, again = (sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=str) for _ in range(2))
    assert first == again and {r.shard for r in first} <= set(range(24))


def test_stages_on_awkward_rows(spark, tmp_path):
    folder = str(tmp_path)
    labels(spark, [(1, 1, 0, ""), (None, None, 1, None), (13, 0, 1, "")]).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "a b c d e f g")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for table in (awkward(spark), nothing(spark)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            before, docs = docs, corpus_pipeline.store(stage(spark, docs, folder), "stage")
            assert docs.columns == before.columns or stage is corpus_pipeline.STAGES[-1][1]
        assert (docs.count() > 0) == (table.count() > 0)
