"""The language model in tasks and by joins."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.catalog import views as V
from threadloom.functions.arrays import Places
from threadloom.operators import admit, language

LANGUAGES = ["de", "en", "es", "fr"]
ODD = [None, "", "ab", "abc", "Äöü ß", "漢字かな", "\U0001f600\U0001f600\U0001f600 x", "ABCabc" * 400_000, "İI ı", "aaaa"]


@pytest.fixture(scope="module")
def model(spark, sf):
    return language.fit(V.table(spark, sf, "documents"), "text", "lang", LANGUAGES)


def large(model, monkeypatch):
    """The same model where a task may hold no gram."""
    monkeypatch.setattr(language, "IN_TASK", 0)
    other = language.LanguageModel(model.weights, model.classes, model.offsets)
    assert other.packed is None
    monkeypatch.undo()
    return other


def test_scores_in_tasks_equal_those_by_joins(spark, sf, model, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)]
    odd = spark.createDataFrame(rows, "row long, t string")
    docs = odd.unionByName(V.table(spark, sf, "documents").select((F.col("doc_id") + 1000).alias("row"), F.col("text").alias("t")))
    other = large(model, monkeypatch)
    a, b = ({r.row: r for r in m.score(docs, "row", F.col("t")).collect()} for m in (model, other))
    assert set(a) == set(b) and 3 in a and not {0, 1, 2} & set(a)
    for k in a:
        assert a[k].grams == b[k].grams
        assert all(a[k][f"s_{c}"] == pytest.approx(b[k][f"s_{c}"], rel=1e-9, abs=2e-6) for c in LANGUAGES)
    labels = [{r.row: r.lang for r in m.predict(docs, "row", F.col("t")).collect()} for m in (model, other)]
    assert labels[0] == labels[1]


def test_english_rows_stay_where_they_are(spark, sf, model, monkeypatch):
    comments = V.comments(spark, sf).select(F.expr("concat('r', pos % 97)").alias("id"), "body")
    kept = admit.keep_english(comments, F.col("body"), model)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Join" not in plan
    other = admit.keep_english(comments, F.col("body"), large(model, monkeypatch))
    assert sorted(map(str, kept.collect())) == sorted(map(str, other.collect()))


def test_a_model_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    model = language.fit(empty, "text", "lang", ["de", "en"])
    got = model.predict(spark.createDataFrame([(1, "some text")], "row long, t string"), "row", F.col("t")).first()
    assert got.lang == "de"


def test_grams_are_counted_where_rows_lie(spark):
    rows = [(t, lang) for t in ODD for lang in ("en", None)]
    counted = language.profile(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
    want = Counter()
    for text, lang in rows:
        low = "i\u0307i \u0131" if text == "İI ı" else (text or "").lower()
        want.update((lang, low[k : k + 3]) for k in range(len(low) - 2))
    assert {(r.lang, r.gram): r.n for r in counted.collect()} == want


@pytest.mark.parametrize("piece", [1, 2, 5, 1 << 18])
def test_pieces_of_texts(monkeypatch, piece):
    monkeypatch.setattr(language, "_PIECE", piece)
    texts = ["xyz", *ODD[:7], "aäa€a\U0001f600" * 4, "", "zz"]
    found = Counter()
    for first, rows, keys in language._text_grams(pa.array(texts)[1:]):
        found.update(zip((first + rows).tolist(), language.gram_texts(keys).to_pylist(), strict=True))
    want = Counter((k, t[at : at + 3]) for k, t in enumerate(texts[1:]) if t for at in range(len(t) - 2))
    assert found == want


def test_places_of_numbers():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64))
    places = Places(keys[::2])
    assert places.find(keys).tolist() == [k // 2 if k % 2 == 0 else len(keys[::2]) for k in range(len(keys))]
    assert Places(keys[:0]).find(keys[:3]).tolist() == [0, 0, 0]
