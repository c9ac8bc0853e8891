import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import helpers
from threadloom.llm import packing, tokens
from threadloom.llm.packing import Limits, Packer, Piece
from threadloom.llm.queries import op7_packing


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_public_tokenizer(reference, monkeypatch):
    path = tokens.default_vocabulary()
    texts = [t for t in helpers.ODD_TEXTS if t] + ["a  b\n\n c  d", "x   y", "it's <|endoftext|> 12 34\r\n\t!"]
    for size in (1 << 16, 16):
        monkeypatch.setattr(tokens, "BLOCK", size)
        for text in texts:
            assert "".join(map(bytes.decode, tokens.blocks(text.encode(), size))) == text
            assert tokens.encode(text.encode(), path).tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "endoftext", "|>", " ", "  ", "\n", "a", "é", "5", "'s"]), max_size=12).map("".join))
def test_the_special_token_is_read_as_the_tokenizer_reads_it(reference, text):
    assert tokens.encode(text.encode(), tokens.default_vocabulary()).tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1' \n\t\r  é漢\x1c.!", max_size=40))
def test_text_can_be_cut_at_every_safe_offset(text):
    path = tokens.default_vocabulary()
    data = text.encode()
    bounds = [0, *tokens.cuts(data).tolist(), len(data)]
    parts = [tokens.ids_of(data[a:b].decode(), path) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [i for p in parts for i in p] == tokens.ids_of(text, path)


def check(pieces, ids_of):
    """Every id in one piece, sequences without gaps, and the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc, parts in by_doc.items():
        ids = np.array([*ids_of[doc], 0], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding


def test_query(spark, sf, reference):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    pieces = op7_packing(spark, sf).collect()
    assert check(pieces, {d.doc_id: reference(d.text) for d in docs}) == 0


def test_odd_rows(spark, reference):
    rows = packing.pack(helpers.odd(spark), keep=("doc_id", "offset"))
    assert rows.columns.count("offset") == 1
    got = rows.collect()
    assert sum(p.length for p in got) == sum(len(reference(t)) + 1 if t else 1 for t in helpers.ODD_TEXTS)
    assert packing.pack(helpers.empty(spark)).count() == 0


def run(limits, cut, sizes):
    packer = Packer(limits, cut, 0)
    for k, (n, loss_from) in enumerate(sizes):
        packer.add(Piece(k, np.arange(n), 0, n, min(loss_from, n)))
    packer.flush()
    bins = defaultdict(list)
    for p in packer.done:
        bins[p.sequence].append(p)
    return bins


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=60), st.booleans())
def test_limits_hold_in_every_dimension(sizes, cut):
    limits = Limits(tokens=32, segments=3, loss=10)
    bins = run(limits, cut, sizes)
    for parts in bins.values():
        assert sum(len(p.ids) for p in parts) <= 32 and len(parts) <= 3 and sum(p.loss for p in parts) <= 10
    placed = sorted((p.owner, i) for parts in bins.values() for p in parts for i in p.ids.tolist())
    assert placed == [(k, i) for k, (n, _) in enumerate(sizes) for i in range(n)]


def test_without_cutting_examples_stay_whole_and_pack_well():
    rng = np.random.default_rng(1)
    sizes = [(int(n), 0) for n in rng.integers(1, 1000, 3000)]
    bins = run(Limits(), False, sizes)
    assert sum(map(len, bins.values())) == len(sizes)
    assert len(bins) <= 1.02 * sum(n for n, _ in sizes) / 1024 + 1


def test_dot_product_mixes_dimensions():
    sizes = [(16, 16)] * 8 + [(16, 0)] * 8  # no loss, all loss
    bins = run(Limits(tokens=32, segments=2, loss=16), False, sizes)
    assert len(bins) == 8 and all(sum(p.loss for p in b) == 16 for b in bins.values())


def test_prompt_bears_no_loss(spark, reference):
    df = spark.createDataFrame([(1, "Say it: ", "hello there"), (2, None, "x")], "doc_id int, prompt string, text string")
    ids, loss = defaultdict(list), defaultdict(int)
    for r in sorted(packing.pack(df, prompt="prompt", with_ids=True).collect(), key=lambda r: r.start):
        ids[r.doc_id] += r.ids
        loss[r.doc_id] += r.loss_tokens
    assert ids[1] == [*reference("Say it: "), *reference("hello there"), 0]
    assert loss == {1: len(reference("hello there")) + 1, 2: 2}
