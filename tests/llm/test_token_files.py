"""Token files: ids, round trips, and what the files look like inside."""

import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import helpers
from threadloom.llm import token_files
from threadloom.llm.queries import op12_token_files
from threadloom.llm.token_files import Encoder, Layout


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(token_files.default_vocabulary())
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def coder():
    return Encoder(token_files.default_vocabulary())


PIECES = ["a", "B", "'s", "it's", " ", "\n\t", "\x0b", "\x1c", "\u0085", " ", " ", "12", "é", "é", " ́", "ß", "Σ", "ΑΣ",
          "漢字", "\U0001f600", "<|endoftext|>", "<|startoftext|>x", "<|", "...", "İ", "가", "̧́"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_words_are_encoded_as_in_the_whole_text(reference, coder, text):
    assert np.frombuffer(coder([text])[0], "<u4").tolist() == reference(text)


def test_the_table_of_words_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 50)
    own = Encoder(token_files.default_vocabulary())
    texts = [f"word{i} {'long' * 40} word{i + 1}" for i in range(200)]
    for at in range(0, 200, 20):
        got = own(texts[at : at + 20])
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [reference(t) for t in texts[at : at + 20]]
        assert len(own.lately) <= 50 + 60 and not any(len(w) > token_files.LONG_WORD for w in own.lately)


def test_other_vocabularies_encode_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode("a  b <|endoftext|> c\n", add_special_tokens=False).ids
    assert np.frombuffer(Encoder(path)(["a  b <|endoftext|> c\n"])[0], "<u4").tolist() == want


def expected(docs, reference):
    """doc_id, start, n_tokens, crc of (doc_id, text) in the order of the ids."""
    out, start = [], 0
    for i, text in docs:
        ids = [*(reference(text) if text else []), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, sf, reference):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = op12_token_files(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(docs, reference)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_odd_rows(spark, reference, encoding):
    """Null ids come last, equal ones in the order of their rows; own columns of added names give way."""
    rows = helpers.odd(spark).withColumn("first", F.lit("own")).withColumn("ids", F.lit("own"))
    folder = token_files.new_stage(spark)
    token_files.write(rows, folder, keep=("doc_id", "a b", "first", "ids"), layout=Layout(encoding))
    back = token_files.read(spark, folder)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in back.collect())
    assert [g[1] for g in got] == [0, 2, 4, 5, 5, 7, None, None, None, None]
    assert {r["a b"] for r in back.collect()} == {"own a b"}
    of = dict(zip(helpers.ODD_IDS, helpers.ODD_TEXTS))
    at = 0
    for start, i, n, ids in got:
        assert start == at and n == len(ids) and ids[-1] == 2
        at += n
        if i not in (None, 5):
            assert ids[:-1] == (reference(of[i]) if of[i] else [])
    texts = sorted(len(reference(t)) + 1 if t else 1 for t in helpers.ODD_TEXTS)
    assert sorted(g[2] for g in got) == texts
    assert token_files.round_trip(helpers.empty(spark)).count() == 0


def test_many_equal_keys_are_spread(spark, shuffle_partitions):
    shuffle_partitions(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(4000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    try:
        parts = [r["count"] for r in token_files.round_trip(rows).groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 8 and max(parts) < 1500


@pytest.mark.parametrize("encoding, ids_in", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_layout_of_the_files(spark, sf, encoding, ids_in):
    """Encodings, row groups, page indexes; a reader of a few columns or keys touches no other."""
    folder = token_files.new_stage(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    token_files.write(docs, folder, layout=Layout(encoding, row_group_bytes=40_000, page_bytes=4_000, page_rows=20))
    files = [pq.ParquetFile(f) for f in glob.glob(f"{folder.removeprefix('file:')}/*.parquet")]
    groups = 0
    for file in files:
        names = [file.metadata.schema.column(i).path for i in range(file.metadata.num_columns)]
        for g in range(file.metadata.num_row_groups):
            groups += 1
            columns = {n: file.metadata.row_group(g).column(i) for i, n in enumerate(names)}
            assert ids_in in columns["ids.list.element"].encodings
            assert "DELTA_BINARY_PACKED" in columns["first"].encodings
            assert all(c.has_offset_index and c.has_column_index for c in columns.values() if c.statistics and c.statistics.has_min_max)
            assert all(c.has_offset_index for c in columns.values())
    assert groups > len(files)
    some = token_files.read(spark, folder).select("doc_id", "n_tokens").where("doc_id between 50 and 60")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema:")[1].split("\n")[0] and "GreaterThanOrEqual(doc_id,50)" in plan
    assert some.count() == 11


def test_unknown_encoding_is_an_error(spark):
    with pytest.raises(ValueError):
        token_files.write(helpers.empty(spark), token_files.new_stage(spark), layout=Layout("plain"))
