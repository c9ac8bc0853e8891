import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import helpers
from threadloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if wins[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


TEXTS = [
    *helpers.ODD_TEXTS,
    "a b c a b c",
    "a a a a",
    "a b c d a b c",
    "l1\nl1\n \n \nl2\nl1",
    "#*$%&|<> é# \x0b x",
    "1 2 3 1 2 3 4 1 2 3",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert quality.base_counts(text.encode() if text is not None else None) == brute(text)


def test_base_rule():
    assert quality.base_failed(49, 0) and not quality.base_failed(50, 25) and quality.base_failed(50, 26)


def test_distance():
    p = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0], [0.25, 0.25, 0.5]])
    d = quality.distance(p, np.array([0.5, 0.5, 0.0]))
    assert d[0] == 0 and d[1] == 1 and 0 < d[2] < 1


def test_keeps_good_and_drops_bad_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.assess(docs).join(labels, "doc_id").where("not base_failed").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.kept.mean() > 0.99
    assert len(bad) and bad.kept.mean() < 0.3


def all_references(spark, folder):
    names = sorted(r.lang for r in spark.read.parquet(folder).select("lang").collect())
    return [quality.reference(folder, n) for n in names]


def test_references_are_bounded_shares(spark):
    refs = all_references(spark, quality.references(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    assert len(refs) >= 3
    for ref in refs:
        assert abs(ref.shares.sum() - 1) < 1e-9 and len(ref.words) <= 1 / quality.WORD_SHARE
        assert abs(ref.classes.sum() - 1) < 1e-9


def test_odd_rows(spark):
    got = quality.assess(helpers.odd(spark))
    assert got.columns.count("n_words") == 1
    rows = got.collect()
    assert len(rows) == 10
    by_text = {r.text: r for r in rows}
    assert by_text[None].n_words == 0 and by_text[None].base_failed and not by_text[None].kept
    assert by_text[helpers.LONG].n_words == 120_000
    assert quality.assess(helpers.empty(spark)).count() == 0


def test_same_references_for_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = (all_references(spark, quality.references(d)) for d in (docs, docs.repartition(6)))
    assert [(r.lang, r.words) for r in a] == [(r.lang, r.words) for r in b]
    assert all((x.shares == y.shares).all() for x, y in zip(a, b, strict=True))


def writer(letters, n=200, size=40, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(letters, k=6)) for _ in range(size)]
    return lambda: " ".join(rng.choices(vocabulary, k=n))


def verdicts(spark, texts, langs):
    rows = quality.assess(helpers.docs(spark, texts, langs)).orderBy("doc_id").collect()
    return [(r.kept, r.judged_by, r.char_distance, r.word_distance) for r in rows]


def test_texts_are_judged_by_their_own_language_only(spark, monkeypatch):
    monkeypatch.setattr(quality, "LANGUAGE_WORDS", 2500)
    common, rare, single = writer("abcdefgh"), writer("абвгдежз"), writer("αβγδεζηθ")
    texts = [common() for _ in range(60)] + [rare() for _ in range(15)] + [single(), single()]
    langs = ["en"] * 60 + ["xx"] * 15 + ["yy", None]
    spam = [writer("0123456789#", size=200)() for _ in range(3)]
    got = verdicts(spark, texts + spam, [*langs, "xx", "zz", None])
    assert [g[0] for g in got] == [True] * 77 + [False, True, True]
    assert [g[1] for g in got[59:]] == ["en"] + ["xx"] * 15 + [None, None, "xx", None, None]
    # many more texts of other languages change nothing
    more = [writer("ijklmnop", seed=s)() for s in range(50)]
    assert verdicts(spark, texts + spam + more, [*langs, "xx", "zz", None, *["vv"] * 50])[:80] == got


def test_sql_says_the_same_with_rare_and_null_languages(spark, monkeypatch, tmp_path):
    """The registered SQL on a table with a rare language, null languages and a language without reference."""
    import duckdb

    from tests.compare import canonical, duck_rows, spark_rows
    from threadloom.llm.oracles import ORACLES
    from threadloom.llm.queries import op8_quality_rules

    words = writer("абвгдежз", n=400)
    texts = [words() for _ in range(60)] + ["0#1% " * 200, *helpers.ODD_TEXTS[:7]]
    rows = helpers.docs(spark, texts, ["xx"] * 61 + [None] * 7, ids=range(10_000, 10_068))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(
        "lang", quality.F.expr("case doc_id % 9 when 0 then null when 1 then 'few' else lang end")
    )
    docs.unionByName(rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(op8_quality_rules(spark, str(tmp_path)))
    assert canonical(got) == canonical(duck_rows(con, ORACLES["op8_quality_rules"]))
    kept = dict(zip(got.doc_id, got.kept))
    assert all(kept[i] for i in range(10_000, 10_060)) and not kept[10_060]
