import itertools
import random

import numpy as np

from tests.llm import helpers
from threadloom.llm import lsh_forest as lf
from threadloom.llm.common import plain_words
from threadloom.llm.queries import op6_ngram_jaccard


def shingle_set(text):
    w = plain_words((text or "").encode())
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(texts):
    """Links between different texts."""
    sets = {t: shingle_set(t) for t in set(texts) - {None}}
    out = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= 0.8 * len(x | y):
            out.add((a, b))
    return out


def family(rng, n, words=60, edits=4):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = base[:]
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def check(spark, texts):
    got = lf.join(helpers.docs(spark, texts)).collect()
    want = brute(texts)
    ids = {}
    for i, t in enumerate(texts):
        ids.setdefault(t, i)
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = by_id[i]
        partners = sorted(ids[b if a == t else a] for a, b in want if t in (a, b))
        assert r.class_id == (i if t is None else ids[t])
        assert r.n_links == len(partners)
    linked = {(r.class_a, r.class_b) for r in lf.pairs(helpers.docs(spark, texts)).collect()}
    assert linked == {tuple(sorted((ids[a], ids[b]))) for a, b in want}


def test_hashes_of_words_do_not_depend_on_place():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randrange(1, 40))) for _ in range(9000)).encode()
    assert len(text) > 3 << 16
    whole = lf.word_hashes(text)
    words = plain_words(text)
    assert len(whole) == len(words)
    table = {w: lf.word_hashes(w)[0] for w in set(words)}
    assert [table[w] for w in words] == whole.tolist() and len(set(table.values())) == len(table)
    long = b"x" * 200_000
    assert lf.word_hashes(long)[0] == lf.word_hashes(b"  " + long + b" y")[0]


def test_shingles_are_sets_of_five_words():
    a, b = "a b c d e f a b c d e", "z a b c d e f"
    assert len(lf.shingles(a.encode())) == len(shingle_set(a))
    common = np.intersect1d(lf.shingles(a.encode()), lf.shingles(b.encode()))
    assert len(common) == len(shingle_set(a) & shingle_set(b))
    assert len(lf.shingles(b"one two")) == 1 and len(lf.shingles(b" ,. ")) == 0


def test_depths_reach_the_target():
    assert lf.recall(0.8, lf.depths(0.8, lf.TARGET)[-1]) >= lf.TARGET
    assert lf.depths(0.8, 0.9)[0] == lf.DEPTH and lf.depths(0.3, 0.999)[-1] == 1


def test_families_and_copies(spark):
    rng = random.Random(5)
    texts = family(rng, 30) + family(rng, 10) + ["solo text of some words here"] * 7 + [None, "", "", " , "]
    texts += [f"{t}" for t in texts[:5]] + ["one two", "one two three"]
    rng.shuffle(texts)
    check(spark, texts)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(lf, "BLOCK", 8)
    check(spark, family(random.Random(9), 60, edits=3))


def test_a_large_group_of_near_copies_does_not_end_the_search(spark):
    base = [f"b{i}" for i in range(600)]
    texts = [" ".join([*base[: 4 * i], f"e{i}", *base[4 * i + 1 :]]) for i in range(150)]
    for k in range(60):  # 80 of 100 shingles in common: at the threshold
        own = [f"y{k}x{i}" for i in range(94)]
        texts += [" ".join(own), " ".join([*own[:84], *(f"q{k}x{i}" for i in range(10))])]
    check(spark, texts)


def test_query_equals_brute_force_at_the_smallest_scale(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute([d.text for d in docs])
    got = op6_ngram_jaccard(spark, sf).where("doc_id = copy_id").collect()
    assert want and sum(r.n_links for r in got) == 2 * len(want)


def groups_of(pairs):
    """The smallest member of each connected member's group."""
    label = {x: x for pair in pairs for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_near_copies_share_a_class(spark, sf):
    rng = random.Random(12)
    texts = [None, *family(rng, 20), *family(rng, 20), "alone here", *[f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(3)]]
    texts += [*texts[1:4], " , ", " , ", None]
    ids = {}
    for i, t in enumerate(texts):
        ids.setdefault(t, i)
    label = groups_of([(ids[a], ids[b]) for a, b in brute(texts)])
    want = [i if t is None else label.get(ids[t], ids[t]) for i, t in enumerate(texts)]
    assert len(set(want)) < len(ids)
    got = {r.doc_id: r.group_id for r in lf.join(helpers.docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want
    # without ids a group has none, with some it has the smallest
    none = lf.join(helpers.docs(spark, texts[1:21], ids=[None] * 20)).collect()
    assert all(r.group_id is None for r in none)

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    first = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        first.setdefault(d.text, d.doc_id)
    label = groups_of([(first[a], first[b]) for a, b in brute([d.text for d in docs])])
    rows = {r.doc_id: r for r in op6_ngram_jaccard(spark, sf).collect()}
    assert label and len(rows) == len(docs)
    for d in docs:
        copy = d.doc_id if d.text is None else first[d.text]
        assert (rows[d.doc_id].copy_id, rows[d.doc_id].class_id) == (copy, label.get(copy, copy))


def test_members_of_a_large_bucket_are_not_dealt_out_many_times(spark):
    base = [f"b{i}" for i in range(400)]
    texts = [" ".join([*base[:i], f"e{i}", *base[i + 1 :]]) for i in range(400)]
    _, classes = lf._classes(helpers.docs(spark, texts), "text", "doc_id", 5)
    buckets = lf._buckets(classes, 4, "signature")
    assert buckets.agg({"size": "max"}).first()[0] > 256
    assert lf._in_groups(buckets).count() == buckets.count() <= lf.TREES * len(texts)


def test_blocks_without_a_member_count_no_pair_twice(spark, monkeypatch):
    monkeypatch.setattr(lf, "BLOCK", 1)
    check(spark, family(random.Random(9), 14, edits=2))


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(lf, "BLOCK_BYTES", 4000)
    check(spark, family(random.Random(8), 40, edits=3))


def test_overlaps_of_many_pairs_are_those_of_each_pair():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64)) for _ in range(90)]
    want = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in itertools.combinations(range(90), 2)]
    left, right = np.triu_indices(90, 1)
    assert lf.overlaps(sets, left, right).tolist() == want
    assert lf.overlaps(sets, left[5:50], right[5:50]).tolist() == want[5:50]


def test_forest_of_a_group():
    rng = random.Random(6)
    for _ in range(50):
        n = rng.randrange(2, 60)
        pairs = [tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.randrange(1, n))]
        label = groups_of(pairs)
        got = lf.forest(n, *np.array(pairs).T)
        assert got.tolist() == [label.get(i, i) for i in range(n)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(30)]
    edges += [(200, i) for i in range(201, 400)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    got = lf.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == label


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    group, other = family(rng, 12, edits=2), family(rng, 3, edits=2)
    texts = [*group, "alone here", *other, *group[:3], None, None]
    kept = lf.one_per_group(helpers.docs(spark, texts))
    rows = kept.collect()
    assert len(kept.columns) == 5
    ids = sorted(r.doc_id for r in rows if r.text is not None)
    assert ids[:2] == [0, 12] and sum(r.text is None for r in rows) == 2
    sets = [shingle_set(r.text) for r in rows if r.text]
    assert all(len(a & b) < 0.8 * len(a | b) for a, b in itertools.combinations(sets, 2))


def test_odd_rows(spark):
    got = lf.join(helpers.odd(spark)).collect()
    assert len(got) == 10 and all(r.n_links == 0 for r in got)
    kept = lf.one_per_group(helpers.odd(spark))
    assert kept.columns.count("digest") == 1
    texts = [r.text for r in kept.collect()]
    assert len(texts) == 9 and set(texts) == set(helpers.ODD_TEXTS)
    for df in (lf.join(helpers.empty(spark)), lf.one_per_group(helpers.empty(spark))):
        assert df.count() == 0
