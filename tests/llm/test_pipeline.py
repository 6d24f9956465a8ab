from __future__ import annotations

from collections import Counter

import corpus_pipeline
from conftest import SF

from corpusweave.llm import decontamination, ngram_join, pii, toxicity

from .test_ngram_join import brute
from .test_text_operators import brute_hits, brute_pii


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "decontamination", "pii", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name in names[:-1]:
        new = stages[name](spark, docs, SF).cache()
        assert new.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in new.collect()}
        before = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            score = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")).scorer()
            assert kept[name] == {i: t for i, t in before.items() if score(t) < 0.7}
        if name == "ngram_jaccard":
            assert kept[name].keys() == {i for i, _, c in brute(list(before.items()), 5, 80) if i == c}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert kept[name] == {i: t for i, t in before.items() if not brute_hits(t, items)[1]}
        if name == "pii":
            assert kept[name].keys() == before.keys() and not any(brute_pii(t) for t in kept[name].values())
            assert all(r.n_chars == len(r.text) for r in new.collect())
        docs = new
    out = stages["packing"](spark, docs, SF).collect()
    assert {r.doc_id for r in out} == kept["pii"].keys()
    whole = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in whole) == Counter((r.doc_id, r.start, r.ids_crc32) for r in out)


def test_stages_take_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_imports_are_there():
    assert all(m for m in (decontamination, ngram_join, pii, toxicity))
