import time
from unittest import mock

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import helpers
from threadloom.llm import token_counts, tokens
from threadloom.llm.queries import op2_token_counts

PATH = tokens.default_vocabulary()


def full(text: bytes) -> int:
    return len(tokens.encode(text, PATH)) if text else 0


@settings(max_examples=300, deadline=None)
@given(
    st.text(alphabet="ab1 \n\t é漢'.", max_size=60),
    st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20), st.text(alphabet="x \n1é'|<", max_size=6)), max_size=6),
    st.sampled_from([0, 64]),
    st.sampled_from([2, 4096]),
)
def test_any_edits_count_like_a_new_text(text, edits, short, grown):
    with mock.patch.object(token_counts, "SHORT", short), mock.patch.object(token_counts, "GROWN", grown):
        edited_like_new(text, edits)


def edited_like_new(text, edits):
    data = text.encode()
    tree = token_counts.TokenTree(data, PATH)
    for start, size, new in edits:
        a = min(start, len(data))
        b = min(a + size, len(data))
        while a and a < len(data) and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        tree.replace(a, b, new.encode())
        data = data[:a] + new.encode() + data[b:]
        assert tree.text == data and tree.length == len(data)
        assert tree.tokens == full(data)


def test_only_the_neighbourhood_is_encoded_again():
    text = helpers.LONG.encode()
    tree = token_counts.TokenTree(text, PATH)
    tree.replace(300_000, 300_010, b"edit")
    assert tree.reencoded < 100
    assert tree.tokens == full(text[:300_000] + b"edit" + text[300_010:])


@pytest.mark.parametrize("unit", ["漢字かな文字12345678交り文。", "слово1234567,", "x12345678"])
def test_texts_without_white_space_cost_in_proportion(unit):
    """Every number of a long text without spaces is edited; what is encoded again grows with the text only."""
    spent = []
    for n in (500, 1000, 2000):
        data = (unit * n).encode()
        _, before, after, size, again = token_counts.count(data, token_counts.cleaning_edits, PATH)
        assert (after, size) == (full(apply(data, token_counts.cleaning_edits(data))), len(apply(data, token_counts.cleaning_edits(data))))
        spent.append(again)
    assert spent[2] <= 4.2 * spent[0] and spent[2] < 3 * len((unit * 2000).encode())


def test_ten_megabytes_without_white_space_and_many_edits():
    data = ("漢字かな文字12345678交り文。" * 260_000).encode()[:10_000_000].decode(errors="ignore").encode()
    edits = token_counts.cleaning_edits(data)[:100_000]
    began = time.process_time()
    found = token_counts.count(data, lambda _: edits, PATH)
    assert found[0] == 100_000 and found[4] < 3 * len(data) and time.process_time() - began < 60


def test_many_insertions_at_one_place():
    tree = token_counts.TokenTree(b"start end", PATH)
    data = b"start end"
    for i in range(3000):
        new = b" word%d" % i
        tree.replace(5, 5, new)
        data = data[:5] + new + data[5:]
    assert tree.text == data and tree.tokens == full(data) and tree.reencoded < 3000 * token_counts.GROWN


def apply(text: bytes, edits) -> bytes:
    for start, end, new in reversed(edits):
        text = text[:start] + new + text[end:]
    return text


def test_query(spark, sf):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_token_counts(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and sum(r.n_edits for r in rows) > 0
    for r in rows:
        edits = token_counts.cleaning_edits(texts[r.doc_id])
        after = apply(texts[r.doc_id], edits)
        assert (r.n_edits, r.tokens_before, r.tokens_after) == (len(edits), full(texts[r.doc_id]), full(after))
        assert r.bytes_after == len(after)


def test_odd_rows(spark):
    got = token_counts.recount(helpers.odd(spark))
    assert got.columns.count("tokens_before") == 1
    rows = got.collect()
    assert len(rows) == 10
    assert all((r.tokens_before, r.n_edits) == (0, 0) for r in rows if not r.text)
    assert token_counts.recount(helpers.empty(spark)).count() == 0
