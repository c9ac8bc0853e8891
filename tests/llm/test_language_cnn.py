import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm import helpers
from threadloom.llm import language_cnn as cnn
from threadloom.llm.queries import op4_language_id


def plain_response(model, codes):
    """The network without pair tables, position by position."""
    last = cnn.WINDOW - max(cnn.WIDTHS) + 1
    parts = []
    for w in cnn.WIDTHS:
        f = model.filters[w]
        parts.append(np.max([sum(f[j][codes[t + j]] for j in range(w)) for t in range(last)], axis=0))
    hidden = np.maximum(np.concatenate(parts) + model.bias, 0)
    out = hidden @ model.dense + model.dense_bias
    return out - np.log(np.exp(out - out.max()).sum()) - out.max()


def test_pair_tables_give_the_filters_responses():
    rng = np.random.default_rng(0)
    f = {w: rng.normal(size=(w, cnn.SYMBOLS, cnn.FILTERS)) for w in cnn.WIDTHS}
    model = cnn.Model(["a", "b"], f, rng.normal(size=24), rng.normal(size=(24, 2)), rng.normal(size=2))
    codes, sizes = cnn.windows("Some text, 12 é und ein weiterer Satz. ".encode() * 9)
    assert len(codes) == 2 and sizes.tolist() == [256, len("Some text, 12 é und ein weiterer Satz. ".encode()) * 9 - 256]
    got = model.log_probabilities(codes)
    for row, c in zip(got, codes, strict=True):
        assert np.allclose(row, plain_response(model, c), atol=1e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op4_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_whole_texts_count(spark, sf):
    """The language of the longer part wins, wherever it stands."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = cnn.fit(docs, F.lit(True))
    by = {r.lang: r.text for r in docs.where("n_chars between 3000 and 6000").collect()}
    mixed = [(by["en"] * 2)[:1500] + (by["de"] * 4)[:7000], (by["de"] * 2)[:1500] + (by["en"] * 4)[:7000]]
    assert model.predict([t.encode() for t in mixed])[0] == ["de", "en"]


def test_odd_rows(spark, sf):
    model = cnn.fit(spark.read.parquet(f"{sf}/documents.parquet"), F.lit(True))
    got = cnn.identify(helpers.odd(spark), model)
    assert got.columns.count("lang_pred") == 1
    rows = got.collect()
    assert len(rows) == 10
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has_letter) and (has_letter or r.score == 0)
    assert cnn.identify(helpers.empty(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    for df in (helpers.empty(spark), helpers.docs(spark, ["1 2", None, "abc"], langs=["en", "de", None])):
        model = cnn.fit(df, F.lit(True))
        assert model.predict([b"hello", None])[0] == ["und", "und"]


def test_prediction_reads_text_only(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = cnn.fit(docs, F.lit(True))
    a = cnn.identify(docs, model, keep=("doc_id",)).collect()
    blind = docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit("s").alias("source"))
    assert sorted(map(tuple, a)) == sorted(map(tuple, cnn.identify(blind, model, keep=("doc_id",)).collect()))


def test_the_sample_does_not_depend_on_the_files(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.repartition(3, "source").write.parquet(f"{tmp_path}/copy")
    copy = spark.read.parquet(f"{tmp_path}/copy")
    drawn = lambda df: cnn.fit(df.unionByName(df.where("doc_id = 3")), F.lit(True))
    a, b = drawn(docs), drawn(copy)
    assert a.labels == b.labels and (a.dense == b.dense).all() and (a.first == b.first).all()
