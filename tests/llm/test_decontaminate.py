import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import helpers
from threadloom.llm import decontaminate as dc
from threadloom.llm.fm_index import FMIndex, suffix_order


def words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items, window):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        ws = words(body)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            p = ws[i : i + window]
            for j in range(len(doc) - len(p) + 1):
                if doc[j : j + len(p)] == p:
                    hit |= set(range(j, j + len(p)))
                    found.add("" if item is None else str(item))
    return len(doc), hit, found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=40), min_size=1, max_size=6), st.data())
def test_index_finds_every_occurrence(runs, data):
    index = FMIndex([np.array(r) for r in runs], 4)
    phrase = data.draw(st.lists(st.integers(1, 3), min_size=1, max_size=6))
    low, high = index.find(np.array([phrase]))
    run, place = index.run_of(index.locate(np.arange(low[0], high[0])))
    want = [(r, i) for r, x in enumerate(runs) for i in range(len(x) - len(phrase) + 1) if x[i : i + len(phrase)] == phrase]
    assert sorted(zip(run.tolist(), place.tolist(), strict=True)) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_order(symbols):
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert suffix_order(np.array(symbols)).tolist() == want


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(alphabet="aBc ,x", max_size=50), max_size=5),
    st.lists(st.text(alphabet="abC -", max_size=20), max_size=4),
    st.integers(1, 30),
)
def test_search_equals_brute_force(texts, bodies, shard):
    items = [(str(i), b) for i, b in enumerate(bodies)]
    known = dc.phrases([(i, b.encode()) for i, b in items], window=3)
    for text, found in zip(texts, dc.search([t.encode() for t in texts], known, shard), strict=True):
        n, hit, names = brute(text, items, 3)
        assert found.n_words == n and found.items == names
        assert {w for a, b in found.spans for w in range(a, b)} == hit


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab. ", max_size=60), max_size=4))
def test_nothing_is_left_after_removal(texts):
    items = [("1", "a b a"), ("2", "b b")]
    known = dc.phrases([(i, b.encode()) for i, b in items], window=3)
    _, left = dc.cleaned([t.encode() for t in texts], [known])
    assert all(not brute(t.decode(), items, 3)[1] for t in left)


def test_removal_keeps_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    texts = [f"Before it, {passage.upper()}. After.", "clean text w1 w2", passage, None, ""]
    items = spark.createDataFrame([(7, passage), (8, None), (9, "")], "item_id long, text string")
    got = dc.decontaminate(helpers.docs(spark, texts), items, remove=True).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["Before it, . After.", "clean text w1 w2", "", None, ""]
    assert [r["items"] for r in got] == [["7"], [], ["7"], [], []]


def test_blocks_of_items_give_the_same(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    a = dc.decontaminate(docs, items, keep=("doc_id",)).orderBy("doc_id").collect()
    b = dc.decontaminate(docs, items, keep=("doc_id",), block_bytes=4000).orderBy("doc_id").collect()
    assert a == b and any(r.spans for r in a)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(alphabet="aBc ,x", max_size=60), max_size=5),
    st.lists(st.text(alphabet="abC -", max_size=20), min_size=1, max_size=6),
    st.integers(1, 7),
    st.randoms(),
)
def test_spans_and_cuts_do_not_depend_on_the_blocks(texts, bodies, n, random):
    items = [(str(i), b.encode()) for i, b in enumerate(bodies)]
    data = [t.encode() for t in texts]
    found, left = dc.cleaned(data, [dc.phrases(items, window=3)])
    random.shuffle(items)
    parts = [dc.phrases([i for k, i in enumerate(items) if k % n == b], window=3) for b in range(n)]
    again, rest = dc.cleaned(data, parts)
    assert rest == left
    assert [(f.n_words, f.spans, f.items) for f in again] == [(f.n_words, f.spans, f.items) for f in found]


def test_phrases_of_two_blocks_are_merged_on_the_text_as_it_came(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(10)) for c in "ab")
    text = f"x x x x x {one} y y y y y y {two}"
    for ids in ((1, 2), (2, 1), (77, 3)):
        items = spark.createDataFrame(list(zip(ids, (one, two))), "item_id long, text string")
        for size in (10_000, 30, 5):
            got = dc.decontaminate(helpers.docs(spark, [text]), items, remove=True, block_bytes=size).first()
            assert got.n_words == 31 and [(s.start, s.end) for s in got.spans] == [(5, 15), (21, 31)]
            assert words(got.text) == ["x"] * 5 + ["y"] * 6


def test_long_items_are_cut_into_pieces_with_the_same_windows():
    text = " ".join(f"w{i % 37}" for i in range(500)).encode()
    whole = dc.phrases([("1", text)])
    for most in (1, 40, 300, 4000):
        parts = dc.pieces(text, most)
        assert len(parts) > 1 or most == 4000
        cut = dc.phrases([("1", p) for p in parts])
        names = [{v: k for k, v in p.words.items()} for p in (whole, cut)]
        sets = [{tuple(n[i] for i in row) for row in p.by_length[10][0].tolist()} for n, p in zip(names, (whole, cut))]
        assert sets[0] == sets[1] and list(cut.by_length) == [10]


def test_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, "word5 of text5 word6 of text6 word7 of text7 word8 of text8"), (1, "same same"), (None, "A"), (2, None)],
        "item_id long, text string",
    )
    got = dc.decontaminate(helpers.odd(spark), items)
    assert got.columns.count("spans") == 1 and got.columns.count("items") == 1
    rows = {r.text: r for r in got.collect()}
    for text, r in rows.items():
        assert (r.n_words, bool(r.spans)) == (len(words(text)), text in ("a", "same same", helpers.LONG))
    assert rows["a"]["items"] == [""] and rows["same same"]["items"] == ["1"]
    assert dc.decontaminate(helpers.empty(spark), items).count() == 0
    assert all(not r.spans for r in dc.decontaminate(helpers.odd(spark), items.limit(0)).collect())


def test_digest():
    assert dc.items_digest([]) == hashlib.sha256(b"").hexdigest()
