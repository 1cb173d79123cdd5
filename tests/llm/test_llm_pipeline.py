"""The pipeline stage by stage against plain Python on the small tables."""

from collections import Counter

import corpus_pipeline
from conftest import SF001
from edge import documents
from panelkit.llm import decontam, mixing, tokens, toxicity
from panelkit.llm.common import table, written
from test_llm_corpus import expected_tokens, naive_components, naive_simhash


def test_pipeline_stages(spark):
    docs = table(spark, SF001, "documents")
    results = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF001), f"test-{k}")
        results.append(docs)
    clean, unique, safe, mixed, coded = results
    before = table(spark, SF001, "documents")
    assert all(r.columns == before.columns for r in results[:-1])
    scored = toxicity.scores(before, table(spark, SF001, "labels", "doc_id", "toxic"))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()}
    prints = {r.doc_id: naive_simhash(r.text) for r in clean.collect()}
    assert Counter(r.doc_id for r in unique.collect()) == Counter(set(naive_components(prints).values()))
    items = [decontam.fold(r.text) for r in table(spark, SF001, "benchmark").collect()]
    gone = {r.doc_id for r in unique.collect()} - {r.doc_id for r in safe.collect()}
    assert gone >= {r.doc_id for r in unique.collect() if any(t in decontam.fold(r.text) for t in items)}
    assert len(gone) < 0.2 * unique.count()
    taken = {r.doc_id: r for r in mixing.taken_words(safe).collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[i] * r.size == r.taken for i, r in taken.items()) and max(times.values()) <= 3
    want = expected_tokens(sorted((r.doc_id, r.text) for r in mixed.collect()))
    assert sorted(tuple(r) for r in coded.collect()) == sorted(want)


def test_run_and_edge_rows(spark, tmp_path):
    n = corpus_pipeline.run(spark, SF001).count()
    assert n > 0
    docs = documents(spark)
    labels = spark.createDataFrame([(9, 1), (10, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    table(spark, SF001, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        now = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = written(stage(spark, now, str(tmp_path)), f"edge-{k}")
        assert set(now.columns) == {"doc_id", "start", "n_tokens", "ids_crc32"}
        assert (now.count() > 0) == (rows is docs)


def test_tokenizer_is_a_parameter():
    assert tokens.TOKENIZER.endswith("byte_bpe_50k.json")
