"""Admission predicates over raw forum rows (boolean columns, never null for kept rows)."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import text as X


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_tombstone(c) -> Column:
    return _col(c).isin(*K.TOMBSTONES)


def has_score(c, minimum: int = K.MIN_SCORE) -> Column:
    """A missing score counts as 0; written so that the scan can apply it."""
    score = _col(c)
    if minimum <= 0:
        return F.coalesce(score, F.lit(0)) >= F.lit(minimum)
    return score.isNotNull() & (score >= F.lit(minimum))


def is_bot(c, names=K.BOT_AUTHORS) -> Column:
    """Listed name, or any name that ends in ``bot``; a missing author counts as a bot."""
    author = F.coalesce(_col(c), F.lit(K.DEFAULT_AUTHOR))
    return author.isin(*names) | F.lower(author).endswith(K.BOT_SUFFIX)


def length_between(c, bounds) -> Column:
    return F.length(_col(c)).between(*bounds)


def contains_any(c, marks) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).contains(m) for m in marks])


def has_loose_link(c) -> Column:
    return contains_any(c, K.LOOSE_LINK_MARKS)


def has_strict_link(c) -> Column:
    return contains_any(c, K.STRICT_LINK_MARKS)


def has_gif(c) -> Column:
    return _col(c).contains(K.GIF_MARK)


def is_ascii(c) -> Column:
    return _col(c).rlike(r"\A[\x00-\x7F]*\z")


def is_all_caps(c) -> Column:
    """At least one letter, and every letter is upper case."""
    letters = X.letter_count(c)
    return (letters > 0) & (X.upper_count(c) == letters)


def title_and_body(title, selftext) -> Column:
    """The text that link and language tests of a submission look at."""
    return F.concat(X.strip_ws(title), F.lit(" "), X.strip_ws(F.coalesce(_col(selftext), F.lit(""))))


def has_valid_length(title, selftext) -> Column:
    """Title 10..200; a body must be 20..1000; without a body the title must be 40 or longer."""
    stripped_title = X.strip_ws(title)
    body = X.strip_ws(F.coalesce(_col(selftext), F.lit("")))
    body_rule = F.when(
        F.length(body) > 0, F.length(body).between(*K.SELFTEXT_LENGTH)
    ).otherwise(F.length(stripped_title) >= K.TITLE_ONLY_MIN)
    return F.length(stripped_title).between(*K.TITLE_LENGTH) & body_rule


def survives_title_recheck(title) -> Column:
    """The cleaned but unstripped title must still have ten characters."""
    return F.length(X.clean_title_unstripped(title)) >= K.RECHECK_TITLE_MIN


# Ordered (reason, test) pairs: the first test that holds is the reason for a rejection.
def comment_rejections(english: Column | None = None) -> list[tuple[str, Column]]:
    tests = [
        ("tombstone", F.coalesce(is_tombstone("body"), F.lit(True))),
        ("score", ~has_score("score")),
        ("bot", is_bot("author")),
        ("length", ~length_between("body", K.BODY_LENGTH)),
        ("link", has_loose_link("body")),
        ("gif", has_gif("body")),
    ]
    return tests + ([("language", ~english)] if english is not None else [])


def submission_rejections(english: Column | None = None) -> list[tuple[str, Column]]:
    title = X.strip_ws("title")
    body = X.strip_ws(F.coalesce(F.col("selftext"), F.lit("")))
    has_body = F.length(body) > 0
    tests = [
        ("tombstone", F.coalesce(is_tombstone(title), F.lit(True))),
        ("bot", is_bot("author")),
        ("score", ~has_score("score")),
        ("title_length", ~length_between(title, K.TITLE_LENGTH)),
        ("all_caps", is_all_caps(title)),
        ("body_length", has_body & ~length_between(body, K.SELFTEXT_LENGTH)),
        ("title_only_length", ~has_body & (F.length(title) < K.TITLE_ONLY_MIN)),
        ("link", has_strict_link(title_and_body("title", "selftext"))),
    ]
    if english is not None:
        tests.append(("language", ~english))
    return tests + [("gif", has_gif(body))]


def first_reason(rejections: list[tuple[str, Column]]) -> Column:
    """Name of the first failing test, null for an admitted row."""
    (name, test), *rest = rejections
    reason = F.when(test, F.lit(name))
    for name, test in rest:
        reason = reason.when(test, F.lit(name))
    return reason


def passes(rejections: list[tuple[str, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [~test for _, test in rejections])
