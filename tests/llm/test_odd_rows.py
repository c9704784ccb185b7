"""Every operator and stage on nulls, empty and very long texts, repeated rows, ties, empty tables and clashing names."""

import hashlib

import pytest

import corpus_pipeline
from riskloom.llm.queries import QUERIES

NAMES = list(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, labels, benchmark, talks, folder, name):
    got = QUERIES[name](spark, folder(documents=odd, labels=labels, benchmark=benchmark, conversations=talks)).collect()
    if name.startswith("op3"):
        assert {(r.doc_id, r.item_id) for r in got} == {(2, 1), (3, 1), (4, 1)}
    elif name.startswith("op4"):
        assert all(r.n_tokens > 0 for r in got)
    elif name.startswith("op11"):
        assert {x.item_id for x in got} <= {1, 4, 5, None} and max(x["rank"] for x in got) <= 50
    elif name.startswith("op13"):
        root = [x for x in got if x.depth == 0]
        assert len(root) == 1 and root[0].n_convs == talks.where("conv_id IS NOT NULL").select("conv_id").distinct().count()
    else:
        assert len(got) == odd.count()


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, nothing, no_labels, benchmark, talks, folder, name):
    empty = benchmark.limit(0)
    assert QUERIES[name](spark, folder(documents=nothing, labels=no_labels, benchmark=empty, conversations=talks.limit(0))).collect() == []


def test_no_labels_and_no_items(spark, odd, no_labels, benchmark, folder):
    at = folder(documents=odd, labels=no_labels, benchmark=benchmark.limit(0))
    assert {r.score for r in QUERIES["op8_toxicity"](spark, at).collect()} == {0.5}
    assert all(r.kept != r.base_failed for r in QUERIES["op10_quality_rules"](spark, at).collect())
    assert QUERIES["op3_decontaminate"](spark, at).count() == 0


def test_secrets(spark, odd, labels, folder):
    got = {r.doc_id: r for r in QUERIES["op1_secret_scan"](spark, folder(documents=odd)).collect() if r.doc_id}
    r = got[9]
    assert (r.n_assign, r.n_access, r.n_hex, r.spans) == (1, 1, 1, "assign:0:18,access:23:43,hex:46:78")
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert got[5].spans == "" and got[5].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_near_copies(spark, odd, folder):
    got = QUERIES["op6_near_copies"](spark, folder(documents=odd)).collect()
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(classes[2]) == [2, 3, 4, 4]
    assert sum(r.first for r in got if r.class_id == 2) == 1
    assert sorted(classes[5], key=str) == [5, 6, None, None], "null texts equal empty ones"
    assert classes[7] == [7]


def test_pipeline(spark, odd, labels, benchmark, folder):
    at = folder(documents=odd, labels=labels, benchmark=benchmark)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert not {2, 3} & set(left), "near copies and leaks go"
    assert left.get(9, "<assign>").startswith("<assign>")
    assert corpus_pipeline.run(spark, at).count() >= 0


def test_pipeline_on_empty_tables(spark, nothing, no_labels, benchmark, folder):
    assert corpus_pipeline.run(spark, folder(documents=nothing, labels=no_labels, benchmark=benchmark.limit(0))).count() == 0
