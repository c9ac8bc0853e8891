"""Column functions against Python's re and str on Unicode edge cases."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import porter
from threadloom.functions import predicates as P
from threadloom.functions import text as X
from threadloom.operators import features

CASES = [
    "", " ", "plain text", "> quote\nrest", "> q\r\nrest\r\n> again", "a > not a line", "a\n>\n>b\n\n>c",
    "\r" * 5, "\U0001f600" * 5, "\n" * 5, "aaaa bbbbb ccc", "!!!!! ????", "ééééé",
    "body\n\xa0EDIT: x", "body\n\x1cedıt: x", "a\n edit: b\nEdit: c", "edit: at start", "x\n\n\tEdIt:",
    " text　", "\x1c\x1dtext\x85", "​text​", "<b>bold</b> a<b", "a <tag\nover lines> b", "<>", "< >",
    "&amp;lt; &lt; &gt; &nbsp;x", "&amp;amp;lt;", "![gif](abc) x ![gif](a\nb)", "![gif]()", "1 < 2 > 1",
    "<think>a\nb</think> c <think>d</think>", "<think>open", "HÉLLO İ ẞ ǅ",
]


def apply(spark, fn, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string").select("i", fn("c").alias("o"))
    return [r["o"] for r in sorted(df.collect(), key=lambda r: r["i"])]


# The patterns and their order, in Python's dialect. The columns must give
# what Python's ``re`` gives for them.
STEPS = {
    "squeeze": (r"(.)\1{3,}", r"\1\1\1", 0),
    "edit": (r"\n\s*edit:.*", "", re.IGNORECASE | re.DOTALL),
    "quotes": (r"^>.*$", "", re.MULTILINE),
    "tags": (r"<[^>]+>", "", 0),
    "gif": (r"!\[gif\]\(.*?\)", "", 0),
    "think": (r"<think>.*?</think>", "", re.DOTALL),
    "space": (r"([+=*<>/-])", r" \1 ", 0),
    "blank": (r"[^a-z0-9+=*<> -]", " ", 0),
}


def python(*steps):
    """A function that applies the named steps in order."""

    def run(t):
        for step in steps:
            if step == "unescape":
                for entity, char in K.ENTITIES:
                    t = char.join(t.split(entity))
            elif step in STEPS:
                pattern, replacement, flags = STEPS[step]
                t = re.compile(pattern, flags).sub(replacement, t)
            else:
                t = getattr(str, step)(t)
        return t

    return run


PAIRS = {
    "squeeze": (X.squeeze_repeats, python("squeeze")),
    "unescape": (X.unescape_entities, python("unescape")),
    "edit": (X.cut_edit, python("edit")),
    "quotes": (X.strip_quotes, python("quotes")),
    "tags": (X.strip_tags, python("tags")),
    "gif": (X.strip_gif, python("gif")),
    "strip": (X.strip_ws, str.strip),
    "comment": (X.clean_comment, python("edit", "quotes", "tags", "squeeze", "unescape", "strip")),
    "selftext": (X.clean_selftext, python("squeeze", "unescape", "edit", "quotes", "tags", "strip")),
    "title": (X.clean_title, python("squeeze", "edit", "quotes", "tags", "strip")),
    "polish": (X.polish, python("quotes", "tags", "gif", "strip")),
    "plain": (X.normalise_text, python("lower", "blank")),
    "spaced": (X.normalise_spaced, python("lower", "space", "blank")),
    "reasoning": (X.strip_reasoning, python("think", "strip")),
    "tokens": (X.tokens, python("lower", "blank", "split")),
    "spaced_tokens": (X.spaced_tokens, python("lower", "space", "blank", "split")),
    "ascii": (P.is_ascii, str.isascii),
    "length": (F.length, len),
}


@pytest.mark.parametrize("name", PAIRS)
def test_matches_python(spark, name):
    column, expected = PAIRS[name]
    assert apply(spark, column, CASES) == [expected(c) for c in CASES]


TEXTS = st.lists(
    st.text(alphabet="aA1 >\n\r\t<b/&amp;lt!.[gif](x)edit:=+*-é \xa0\U0001f600", max_size=40),
    min_size=1,
    max_size=60,
)


@settings(max_examples=6, deadline=None)
@given(values=TEXTS)
def test_matches_python_on_random_text(spark, values):
    for name in ("comment", "selftext", "title", "polish", "tokens", "spaced_tokens"):
        column, expected = PAIRS[name]
        assert apply(spark, column, values) == [expected(v) for v in values], name


def test_squeeze_is_idempotent(spark):
    once = apply(spark, X.squeeze_repeats, CASES)
    assert apply(spark, X.squeeze_repeats, once) == once


def test_polish_is_not_idempotent(spark):
    once = apply(spark, X.polish, [" > x"])
    assert once == ["> x"] and apply(spark, X.polish, once) == [""]


def test_all_caps(spark):
    values = ["HELLO", "HELLo", "123", "", "ÉTÉ 1", "Ⓐ", "ẞǅ", "Aé"]

    want = [True, False, False, False, True, False, False, False]
    assert apply(spark, P.is_all_caps, values) == want


def test_char_ngrams_are_code_points(spark):
    values = ["ab", "abc", "a\U0001f600bc\U0001f601", "x\ny z"]
    want = [[v[i : i + 3] for i in range(len(v) - 2)] for v in values]
    assert apply(spark, lambda c: X.char_ngrams(c, 3), values) == want


def test_stop_words_and_lists():
    assert len(K.STOP_WORDS) == 179 and len(K.BOT_AUTHORS) == 15 and len(K.MATH_SOURCES) == 10
    assert len(K.WHITESPACE) == 29 and all(c.isspace() for c in K.WHITESPACE)


def test_word_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],), ([],)], "w array<string>")
    got = [r["t"] for r in df.select(X.ngram_terms("w").alias("t")).collect()]
    assert got == [["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"], ["x"], []]


def test_tool_calls(spark):
    values = ["<TOOL_CALL>\nimport os\nx\n</TOOL_CALL>", "none", "a <TOOL_CALL>\nprint(1)\n</TOOL_CALL> b", "<TOOL_CALL>\nimport osx\n</TOOL_CALL>"]
    assert apply(spark, X.extract_tool_call, values) == ["import os\nx", None, "print(1)", "import osx"]
    blocked = apply(spark, lambda c: X.imports_blocked(X.extract_tool_call(c)), values)
    assert blocked == [True, None, False, False]


@pytest.mark.parametrize(
    "word,want",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("caress", "caress"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"),
        ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"),
        ("tanned", "tan"), ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"),
        ("valenci", "valenc"), ("digitizer", "digit"), ("conformabli", "conform"), ("radicalli", "radic"),
        ("differentli", "differ"), ("vileli", "vile"), ("analogousli", "analog"), ("vietnamization", "vietnam"),
        ("predication", "predic"), ("operator", "oper"), ("feudalism", "feudal"), ("decisiveness", "decis"),
        ("hopefulness", "hope"), ("callousness", "callous"), ("formaliti", "formal"), ("sensitiviti", "sensit"),
        ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("formative", "form"), ("formalize", "formal"),
        ("electriciti", "electr"), ("electrical", "electr"), ("hopeful", "hope"), ("goodness", "good"),
        ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"),
        ("gyroscopic", "gyroscop"), ("adjustable", "adjust"), ("defensible", "defens"), ("irritant", "irrit"),
        ("replacement", "replac"), ("adjustment", "adjust"), ("dependent", "depend"), ("adoption", "adopt"),
        ("homologou", "homolog"), ("communism", "commun"), ("activate", "activ"), ("angulariti", "angular"),
        ("homologous", "homolog"), ("effective", "effect"), ("bowdlerize", "bowdler"), ("probate", "probat"),
        ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("dying", "die"),
        ("news", "news"), ("innings", "inning"), ("died", "die"), ("spied", "spi"), ("enjoy", "enjoy"),
        ("by", "by"), ("is", "is"), ("+", "+"), ("5-3", "5-3"), ("geology", "geolog"), ("skies", "sky"),
    ],
)
def test_stems(word, want):
    assert porter.stem(word) == want


def test_stem_columns(spark):
    df = spark.createDataFrame([(1, ["running", "cats", "cats"], "flies"), (2, [], None), (3, None, "x")], "k int, w array<string>, c string")
    stems = df.select("k", porter.stem_token("c").alias("c")).collect()
    assert sorted((r["k"], r["c"]) for r in stems) == [(1, "fli"), (2, None), (3, "x")]
    rows = features.stemmed(df, "w").collect()
    assert sorted((r["k"], r["w"]) for r in rows) == [(1, ["run", "cat", "cat"]), (2, []), (3, [])]
