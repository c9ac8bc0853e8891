"""Text cleaning and normalising as native column expressions (no Python UDF).

Regular expressions follow Python's ``re`` on Unicode text: ``(?d)`` limits line ends to
``\\n`` and the whitespace class is spelled out, because Java's defaults differ.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: all 29 whitespace characters at both ends."""
    return F.btrim(_col(c), F.lit(K.WHITESPACE))


def squeeze_repeats(c) -> Column:
    """Runs of four or more of one character become three; newlines stay."""
    return F.regexp_replace(_col(c), r"([^\n])\1{3,}", "$1$1$1")


def unescape_entities(c) -> Column:
    """Decode four entities in their fixed order, so ``&amp;lt;`` ends as ``<``."""
    return reduce(lambda e, pair: F.replace(e, F.lit(pair[0]), F.lit(pair[1])), K.ENTITIES, _col(c))


def cut_edit(c) -> Column:
    """Text before the first line that starts with ``edit:`` in any case."""
    return F.split(_col(c), r"(?iu)\n" + K.WHITESPACE_CLASS + "*edit:", 2).getItem(0)


def strip_quotes(c) -> Column:
    """Blank every line that starts with ``>``; its newline stays."""
    return F.regexp_replace(_col(c), r"(?dm)^>.*$", "")


def strip_tags(c) -> Column:
    """Remove ``<...>`` spans, also across lines."""
    return F.regexp_replace(_col(c), r"<[^>]+>", "")


def strip_gif(c) -> Column:
    """Remove ``![gif](...)`` markers."""
    return F.regexp_replace(_col(c), r"!\[gif\]\([^\n]*?\)", "")


def strip_reasoning(c) -> Column:
    """Delete ``<think>...</think>`` blocks and strip."""
    return strip_ws(F.regexp_replace(_col(c), r"(?s)<think>.*?</think>", ""))


def clean_comment(c) -> Column:
    """Edit cut, quotes, tags, repeats, entities, strip; entities come last on purpose."""
    return strip_ws(unescape_entities(squeeze_repeats(strip_tags(strip_quotes(cut_edit(c))))))


def clean_selftext(c) -> Column:
    """Repeats, entities, edit cut, quotes, tags, strip; empty or null values stay."""
    raw = _col(c)
    cleaned = strip_ws(strip_tags(strip_quotes(cut_edit(unescape_entities(squeeze_repeats(raw))))))
    return F.when(F.length(raw) > 0, cleaned).otherwise(raw)


def clean_title_unstripped(c) -> Column:
    """Repeats, edit cut, quotes, tags; entities are left as they are."""
    return strip_tags(strip_quotes(cut_edit(squeeze_repeats(c))))


def clean_title(c) -> Column:
    return strip_ws(clean_title_unstripped(c))


def polish(c) -> Column:
    """Second pass over cleaned bodies: quotes, tags, gif markers, strip."""
    return strip_ws(strip_gif(strip_tags(strip_quotes(c))))


def normalise_text(c) -> Column:
    """Lower case; everything outside ``a-z0-9+=*<> -`` becomes a space."""
    return _blank_others(F.lower(_col(c)))


def _blank_others(c: Column) -> Column:
    """The look-ahead form of ``[^...]``, which Java evaluates four times faster."""
    return F.regexp_replace(c, r"(?s)(?![a-z0-9+=*<> -]).", " ")


def normalise_spaced(c) -> Column:
    """As ``normalise_text`` with spaces put round the operators ``+=*<>/-`` first."""
    spaced = reduce(
        lambda text, op: F.replace(text, F.lit(op), F.lit(f" {op} ")), "+=*<>/-", F.lower(_col(c))
    )
    return _blank_others(spaced)


def tokens(c) -> Column:
    """The words of ``normalise_text(c)``: runs of kept characters, found in one pass."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([a-z0-9+=*<>-]+)"), F.lit(1))


def spaced_tokens(c) -> Column:
    """The words of ``normalise_spaced(c)``: every operator is a word of its own."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([a-z0-9]+|[+=*<>-])"), F.lit(1))


def remove_stopwords(words, stop_words=K.STOP_WORDS) -> Column:
    """Drop stop words from a token array; order and duplicates stay."""
    return F.filter(_col(words), lambda w: ~w.isin(*stop_words))


def letter_count(c) -> Column:
    return F.length(F.regexp_replace(_col(c), r"[^\p{L}]", ""))


def upper_count(c) -> Column:
    return F.length(F.regexp_replace(_col(c), r"[^\p{IsUppercase}]", ""))


def word_terms(c) -> Column:
    """Tokens of two or more word characters, for n-gram features."""
    return F.regexp_extract_all(_col(c), F.lit(r"\b(\w\w+)\b"), F.lit(1))


def ngrams(words: str, n: int) -> Column:
    """The n-grams of a token array column (named, so that it is computed once)."""
    arr = F.col(words)
    if n == 1:
        return arr
    starts = F.slice(arr, F.lit(1), F.greatest(F.size(arr) - F.lit(n - 1), F.lit(0)))
    return F.transform(
        starts,
        lambda w, i: F.concat_ws(" ", w, *[F.get(arr, i + F.lit(k)) for k in range(1, n)]),
    )


def ngram_terms(words: str, ngram_range=K.NGRAM_RANGE) -> Column:
    """All n-grams of the range, shortest first."""
    return F.concat(*[ngrams(words, n) for n in range(ngram_range[0], ngram_range[1] + 1)])


def char_ngrams(c, n: int) -> Column:
    """All overlapping character n-grams, in one linear pass.

    The look-ahead captures the gram without consuming it; the first test skips positions
    inside a surrogate pair, so a gram is n code points.
    """
    return F.regexp_extract_all(_col(c), F.lit(rf"(?s)(?!\p{{Cs}})(?=(.{{{n}}}))"), F.lit(1))


def wrap_tool_call(c) -> Column:
    return F.concat(F.lit("<TOOL_CALL>\n"), _col(c), F.lit("\n</TOOL_CALL>"))


def extract_tool_call(c) -> Column:
    """Code inside the first tool call, null when there is none."""
    code = F.regexp_extract(_col(c), r"(?s)<TOOL_CALL>\n(.*?)\n</TOOL_CALL>", 1)
    return F.when(_col(c).rlike(r"(?s)<TOOL_CALL>\n.*?\n</TOOL_CALL>"), code)


def imports_blocked(code, modules=K.BLOCKED_MODULES) -> Column:
    """Whether a line of the code imports one of the blocked modules."""
    return _col(code).rlike(r"(?m)^\s*(import|from)\s+(" + "|".join(modules) + r")\b")


def preview(c, width: int = 30) -> Column:
    """First ``width`` characters, left-aligned and padded."""
    return F.rpad(F.substring(_col(c), 1, width), width, " ")


def percent(c) -> Column:
    """Share as a percentage with one decimal."""
    return F.format_number(_col(c) * 100, 1)
