import difflib
import itertools
import random

from tests.llm import helpers
from threadloom.llm import line_dedup as ld
from threadloom.llm.queries import op1_line_dedup


def test_blocks_are_common_ordered_and_disjoint():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(30) for _ in range(rng.randrange(40))]
        b = a[:]
        for _ in range(rng.randrange(8)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randrange(len(b) + 1), rng.randrange(60))
        at = (0, 0)
        for i, j, n in ld.blocks(a, b):
            assert n > 0 and i >= at[0] and j >= at[1] and a[i : i + n] == b[j : j + n]
            at = (i + n, j + n)


def test_unique_lines_align_like_the_longest_match():
    a = [f"line{i}" for i in range(50)]
    b = ["new"] + a[5:20] + ["x", "y"] + a[30:45]
    want = [tuple(m) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()[:-1]]
    assert ld.blocks(a, b) == want


def test_moved_block_keeps_the_longer_order():
    a = list("abcdefgh")
    assert ld.blocks(a, list("efghabc")) == [(4, 0, 4)]


def lines_of(text):
    return [" ".join(s.split()) for s in (text or "").split("\n") if s.strip()]


def common_places(a, b, min_words):
    """Places of b in a run of min_words words that a has, by comparing all starts."""
    gone, at = set(), {}
    for i, s in enumerate(a):
        at.setdefault(s, []).append(i)
    for j, s in enumerate(b):
        for i in at.get(s, []):
            if i and j and a[i - 1] == b[j - 1]:
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(len(x.split()) for x in b[j : j + n]) >= min_words:
                gone |= set(range(j, j + n))
    return gone


def test_query_equals_brute_force(spark, sf):
    """Every run of 25 words that any earlier document has is gone; beyond that only lines of earlier
    documents beside such a run, within the gap of the alignment."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    lines = [lines_of(d.text) for d in docs]
    got = {r.doc_id: r for r in op1_line_dedup(spark, sf).collect()}
    assert len(got) == len(docs)
    removed = 0
    for k, d in enumerate(docs):
        r, filled = got[d.doc_id], [i for i, s in enumerate(d.text.split("\n")) if s.strip()]
        gone = {filled.index(i) for i in r.removed_lines}
        want = set().union(*(common_places(lines[e], lines[k], ld.MIN_WORDS) for e in range(k)))
        assert gone >= want and r.n_removed == len(gone)
        earlier = {s for e in range(k) for s in lines[e]}
        for j in gone - want:
            assert lines[k][j] in earlier and want
        removed += len(gone)
        assert lines_of(r.text) == [s for j, s in enumerate(lines[k]) if j not in gone]
    assert removed


def test_the_diff_decides_about_short_blocks(monkeypatch):
    """Short lines beside a long block go if the diff aligns them with it, and only then."""
    long_ = [f"l{i}" for i in range(3)]
    earlier = ["s1", "x", *long_, "s2", "y", "s3", "far", "far2", "s4"]
    later = ["s1", "z", *long_, "s2", "changed", "s3", "new", "new2", "new3", "s4"]
    words = [2 if h not in long_ else 10 for h in later]
    gone = [later[j] for j in ld.long_blocks(earlier, later, words, 25)]
    assert gone == ["s1", *long_, "s2", "s3"]
    moved = ["s3", *later[:7]]
    assert "s3" not in [moved[j] for j in ld.long_blocks(earlier, moved, [2 if h not in long_ else 10 for h in moved], 25)]
    monkeypatch.setattr(ld, "blocks", lambda a, b: [])
    assert [later[j] for j in ld.long_blocks(earlier, later, words, 25)] == [*long_, "s2"]


def test_rare_runs_are_taken_first():
    shared = [(900, 0, 3), (2, 1, 4), (900, 2, 5), (3, 3, 6)]
    assert ld.rarest(shared) == [1, 3, 0]
    rng = random.Random(4)
    for _ in range(200):
        runs = [(rng.randrange(9), a, a + rng.randrange(1, 6)) for a in (rng.randrange(30) for _ in range(rng.randrange(20)))]
        chosen = ld.rarest(runs)
        places = [set(range(a, b)) for _, a, b in runs]
        assert set().union(*(places[k] for k in chosen)) == set().union(*places)


def test_a_rare_run_spares_the_common_one(spark):
    """Documents that share a long rare block around a boilerplate are linked to its holder only."""
    boiler = "\n".join(PASSAGE)
    rare = "\n".join(" ".join(f"{c}{i}" for i in range(20)) for c in "uvw")
    texts = [boiler, *[f"d{i}\n{boiler}" for i in range(5)], f"r1\n{rare}\n{boiler}\n{rare}x", f"r2\n{rare}\n{boiler}\n{rare}x"]
    got = clean(spark, texts)
    assert got[0] == boiler and got[1:6] == [f"d{i}" for i in range(5)]
    assert lines_of(got[6]) == lines_of(f"r1\n{rare}\n{rare}x") and got[7] == "r2"


PASSAGE = [" ".join(f"{c}{i}" for i in range(20)) for c in "pqr"]


def clean(spark, texts, **options):
    rows = ld.dedup(helpers.docs(spark, texts), **options).orderBy("doc_id").collect()
    return [r.text for r in rows]


def test_repeated_and_moved_passages_go():
    p, q = list("pqr"), list("stu")
    cases = [
        (["a1", *p, "a2", *p, "a3"], ["c1", *p, "c2"], p),
        (["a1", *p, "a2"], ["c1", *p, "c2", *p, "c3"], p + p),
        (["a1", *p, "a2", *q], [*q, "c1", *p, "p", "c2"], q + p),
    ]
    for earlier, later, gone in cases:
        places = ld.long_blocks(earlier, later, [10] * len(later), 25)
        assert [later[j] for j in places] == gone


def test_all_common_runs_go():
    rng = random.Random(2)
    for _ in range(300):
        size = [rng.randrange(1, 20) for _ in range(8)]
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(40))] for _ in range(2))
        want = set()
        for i, j in itertools.product(range(len(a)), range(len(b))):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(size[x] for x in b[j : j + n]) >= 25:
                want |= set(range(j, j + n))
        gone = set(ld.long_blocks(a, b, [size[x] for x in b], 25))
        beside = {j for _, s, n in ld.blocks(a, b) for j in range(s, s + n)}
        assert want <= gone <= want | beside and (want or not gone)


def test_later_copies_of_a_passage_go(spark):
    block = "\n".join(PASSAGE)
    texts = ["own start\n" + block, "other\n\n" + block.replace("\n", "\n\n") + "\nend", block, "short\nown start\n" + "short"]
    got = clean(spark, texts)
    assert got[0] == texts[0] and got[2] == "" and got[3] == texts[3]
    assert [s for s in got[1].split("\n") if s] == ["other", "end"]


def test_a_passage_whose_lines_have_several_first_holders(spark):
    firsts = [f"start {i}\n{line}\nend {i}" for i, line in enumerate(PASSAGE)]
    texts = firsts + [f"open {i}\n" + "\n".join(PASSAGE) + f"\nclose {i}" for i in range(4)]
    got = clean(spark, texts)
    assert got[:4] == texts[:4]
    assert got[4:] == [f"open {i}\nclose {i}" for i in range(1, 4)]


def test_the_last_short_line_of_a_block_goes_too(spark):
    first = "\n".join(["start one", *PASSAGE, "start two"])
    longer = [*PASSAGE, "short tail"]
    texts = [first, "\n".join(["a", *longer, "b"]), "\n".join(["c", *longer, "d"])]
    assert clean(spark, texts)[1:] == ["a\nshort tail\nb", "c\nd"]


def test_many_copies_and_a_common_line(spark):
    long = " ".join(f"t{i}" for i in range(60))
    texts = [f"common line\n{long}" for _ in range(200)] + [f"common line\nown words {i}" for i in range(200)]
    got = clean(spark, texts)
    assert got[0] == texts[0] and set(got[1:200]) == {""} and got[200:] == texts[200:]


def test_every_line_stays_somewhere(spark, sf):
    rows = op1_line_dedup(spark, sf).collect()
    before = {s.strip() for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for s in r.text.split("\n")}
    after = {s.strip() for r in rows for s in r.text.split("\n")}
    assert before - {""} == after - {""}


def test_odd_rows(spark):
    got = ld.dedup(helpers.odd(spark))
    assert got.columns.count("n_lines") == 1 and got.columns.count("places") == 1
    rows = got.collect()
    assert len(rows) == 10 and sum(r.text is None for r in rows) == 1
    assert sorted(r.text or "" for r in rows) == sorted(t or "" for t in helpers.ODD_TEXTS)
    assert ld.dedup(helpers.empty(spark)).count() == 0


def test_repeated_rows_with_one_id_leave_one(spark):
    long = " ".join(f"t{i}" for i in range(60))
    rows = ld.dedup(helpers.docs(spark, [long] * 5, ids=[None, 3, 3, 3, None])).collect()
    assert sorted((r.doc_id or -1, r.text) for r in rows if r.text) == [(3, long)]


def test_no_cross_join(spark, sf):
    plan = op1_line_dedup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
