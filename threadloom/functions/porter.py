"""Porter stemmer (published algorithm with the usual later extensions) for Arrow batches.

``stem_token`` maps a column of words, ``stem_words`` a column of word lists. Both stem each
distinct word of a batch once and map the others by their dictionary codes; nothing is shuffled.
"""

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Irregular forms and suffix tables of the algorithm.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """``c``/``v`` per letter; ``y`` is a vowel after a consonant."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c", _shape(word)))


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("sses"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    base = next((w[: -len(s)] for s in ("ed", "ing") if w.endswith(s) and "v" in _shape(w[: -len(s)])), None)
    if base is None:
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _short_end(base) else base


def _swap(w: str, table) -> str:
    """Apply the first suffix of the table that fits, if the rest has a measure."""
    for suffix, replacement in table:
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            return rest + replacement if _measure(rest) > 0 else w
    return w


def _step_2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step_2(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _swap(w, STEP_2)


def _step_4(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            fits = _measure(rest) > 1 and (suffix != "ion" or rest[-1] in "st")
            return rest if fits else w
    return w


def _final(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


@lru_cache(maxsize=1 << 17)
def stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and len(w) > 2 and _shape(w)[-2] == "c":
        w = w[:-1] + "i"
    return _final(_step_4(_swap(_step_2(w), STEP_3)))


def _stems(words: pa.Array) -> pa.Array:
    codes = words.dictionary_encode()
    stems = pa.array([stem(w) for w in codes.dictionary.to_pylist()], pa.string())
    return stems.take(codes.indices)


@F.arrow_udf(T.StringType())
def stem_token(words: pa.Array) -> pa.Array:
    return _stems(words)


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_words(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, _stems(lists.flatten()), mask=pc.is_null(lists))
