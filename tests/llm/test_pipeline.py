"""The pipeline's stages against plain versions of them, and its odd inputs."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import helpers
from tests.llm.test_decontaminate import words
from tests.llm.test_lsh_forest import shingle_set
from threadloom.llm import quality
from threadloom.session import materialise


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(materialise(stage(spark, out[-1], sf)))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    assert all(df.columns == stages[0].columns for df in stages[1:-1])
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_rejected_documents_go_and_others_stay(stages):
    verdicts = {r.doc_id: r.kept for r in quality.assess(stages[0]).collect()}
    assert {r.doc_id for r in stages[1].collect()} == {i for i, kept in verdicts.items() if kept}


def test_lines(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: r.text for r in stages[2].collect()}
    assert set(after) <= set(before)
    first = {}
    for i in sorted(before):
        for s in before[i].split("\n"):
            first.setdefault(s.strip(), i)
    for i, text in before.items():  # a document whose lines are its own is untouched
        if all(first[s.strip()] == i for s in text.split("\n")):
            assert after[i] == text
    assert any(after.get(i) != t for i, t in before.items())


def test_no_near_copies_are_left(stages):
    before = {r.doc_id: shingle_set(r.text) for r in stages[2].collect()}
    after = {r.doc_id for r in stages[3].collect()}
    near = {(a, b) for a, b in itertools.combinations(sorted(before), 2) if near_copies(before[a], before[b])}
    assert all(a not in after or b not in after for a, b in near)
    linked = {i for pair in near for i in pair}
    assert set(before) - linked <= after
    assert all(min(pair) in after for pair in near if not any(min(pair) == b for _, b in near))


def near_copies(a, b):
    return bool(a and b) and len(a & b) >= 0.8 * len(a | b)


def test_no_benchmark_passage_is_left(spark, sf, stages):
    windows = set()
    for item in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        ws = words(item.text)
        windows |= {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))}
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    dirty = {i for i, t in before.items() if any(tuple(words(t)[k : k + 10]) in windows for k in range(len(words(t))))}
    assert dirty and all(after[i] == t for i, t in before.items() if i not in dirty)
    for text in after.values():
        ws = words(text)
        assert not any(tuple(ws[k : k + 10]) in windows for k in range(len(ws)))


def test_packed_ids(stages):
    pieces = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in stages[4].collect()}
    assert all(r.n == r["all"] for r in pieces)
    assert stages[5].where("size(ids) <> length").isEmpty()


@pytest.mark.parametrize("k", range(5))
def test_odd_rows(spark, sf, k):
    name, stage = cp.STAGES[k]
    got = stage(spark, helpers.odd(spark), sf)
    assert len(set(got.columns)) == len(got.columns)
    rows = got.collect()
    assert len(rows) >= (1 if k == 0 else 9), name
    assert stage(spark, helpers.empty(spark), sf).count() == 0


def test_run(spark, sf, stages):
    got = cp.run(spark, sf)
    assert got.columns == stages[5].columns
    assert got.selectExpr("sum(length)").first() == stages[5].selectExpr("sum(length)").first()
