"""The corpus pipeline against plain Python versions of its stages."""

import brute
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from ebbtide.functions.staging import stage
from ebbtide.llm import language

ROOT = "/root/testdata/sf0.001"


def test_stages_equal_their_plain_versions(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = docs.columns
    model = language.fit(docs.where(~language.held_out()))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    plain = {
        "language ID": lambda rows: {d for d, t in rows if not model.predict(t)[2]},
        "exact dedup": lambda rows: {d for d, e in brute.exact(rows).items() if e[2]},
        "n-gram Jaccard join": lambda rows: {d for d, e in brute.near(rows).items() if e[1] == d},
        "benchmark decontamination": lambda rows: {d for d, e in brute.hits(rows, bench).items() if not e[1]},
    }
    for name, function in corpus_pipeline.STAGES[:-1]:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(function(spark, docs, ROOT), "test")
        assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} == plain[name](rows), name
    rows = docs.collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.SPACED.findall(r.text or ""))
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    for source, target in brute.targets(sizes).items():
        assert sum(r.epoch_words for r in mixed if r.source == source) == pytest.approx(target, abs=0.51)
    whole = entry_module.queries()["pipeline"](spark, ROOT)
    assert sorted((r.doc_id, r.epoch, r.epoch_words) for r in whole.collect()) == sorted((r.doc_id, r.epoch, r.epoch_words) for r in mixed)


def test_stages_take_empty_and_null_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2 + [(5, None, None, None, None), (6, "", None, None, None)], docs.schema)
    for start in (docs.limit(0), nulls):
        for _, function in corpus_pipeline.STAGES:
            assert function(spark, start, ROOT).count() >= 0


def test_every_operator_is_registered():
    names = entry_module.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
