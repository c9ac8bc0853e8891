"""Quality rules: base counts of a text, and its distance to the references of the languages.

A document is compared with the reference of its language by two Jensen-Shannon distances (base
2, so 0 to 1): over character classes, and over the common words of the language plus "any
other word". References are sums over all documents of a language that pass
the base rules; a word is common if it makes
up at least ``WORD_SHARE`` of a language's words, which bounds every list by 1 / WORD_SHARE.

A language has a reference from ``LANGUAGE_WORDS`` words on, as shares of fewer are noise. Documents
without a language (null), or whose language has no reference, are left to the base rules. So texts of one
language never change the verdict on those of another. References are a written table; a task reads those it meets.

Histograms of short texts are noise, so texts below ``CHAR_MIN_WORDS`` or ``WORD_MIN_WORDS``
words are not judged by them, and the limit on words falls with the length.

A null text has no words and no characters: it fails the base rule, as an empty one does.
Rows are judged one by one: ids may repeat or be null, other columns are not looked at; added
columns replace columns of the same name. An empty table gives an empty result.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import as_bytes, plain_words, rest_of, schema_of, slices
from threadloom.session import materialise, new_stage, open_uri

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WORD_SHARE = 0.001
LANGUAGE_WORDS = 20_000
#: Folders of the table of references.
BUCKETS = 64
CHAR_LIMIT = 0.33
CHAR_MIN_WORDS = 50
WORD_MIN_WORDS = 100
#: The limit on the word distance is WORD_FLOOR + WORD_NOISE / sqrt(words), WORD_MOST at most.
WORD_FLOOR = 0.215
WORD_NOISE = 2.2
WORD_MOST = 0.5
_FLUSH = 100_000
_SYMBOLS = b"#*$%&|<>"

#: Character classes as byte sets; the rest are bytes outside ASCII.
_CLASSES = [
    bytes(range(97, 123)),
    bytes(range(65, 91)),
    b"0123456789",
    b" \t\n\x0b\x0c\r",
    _SYMBOLS,
    b".,;:'\"-()",
    b"!?",
]
_REST_OF_ASCII = bytes(sorted(set(range(128)) - set(b"".join(_CLASSES))))
_TABLE = np.full(256, len(_CLASSES) + 1)
for _i, _members in enumerate([*_CLASSES, _REST_OF_ASCII]):
    _TABLE[list(_members)] = _i
CLASSES = len(_CLASSES) + 2

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def word_limit(n_words: int) -> float:
    """The largest word distance of a clean text: a floor plus the noise of its length."""
    return min(WORD_MOST, WORD_FLOOR + WORD_NOISE / math.sqrt(n_words))


def class_counts(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(_TABLE, weights=by_byte, minlength=CLASSES).astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(index) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    often = counts[inverse] > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + len(often)] |= often
    return int(hit.sum())


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The five counts of ``COUNTS``; words are runs without ASCII white space."""
    text = text or b""
    words = text.split()
    marks = sum(len(w) for w in words)
    joined = b"".join(words)
    follow = len(joined) - len(joined.translate(None, bytes(range(128, 192))))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(words), marks - follow, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, item, n): words of a language, and characters of a class."""
    found: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def flush():
        langs, kinds, items, numbers = [], [], [], []
        for lang, counter in found.items():
            langs += [lang] * len(counter)
            kinds += ["w"] * len(counter)
            items += counter
            numbers += counter.values()
        for lang, counts in classes.items():
            langs += [lang] * len(counts)
            kinds += ["c"] * len(counts)
            items += [b"%d" % i for i in range(len(counts))]
            numbers += counts.tolist()
        found.clear()
        classes.clear()
        columns = [pa.array(langs, pa.string()), pa.array(kinds, pa.string())]
        columns += [pa.array(items, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "kind", "item", "n"])

    for batch in slices(batches):
        for text, lang in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = (text or b"").split()
            if lang is None or base_failed(len(words), repeated_words(words)):
                continue
            found.setdefault(lang, Counter()).update(plain_words(text))
            classes[lang] = classes.get(lang, 0) + class_counts(text)
            if sum(map(len, found.values())) > _FLUSH:
                yield flush()
    yield flush()


@dataclass
class Reference:
    """One language: shares of the character classes, its common words and their shares."""

    lang: str
    classes: np.ndarray
    words: list[bytes]
    shares: np.ndarray


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> str:
    """The folder of the table of references: ``lang``, ``total``, ``items``, by a hash of the language."""
    columns = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = (
        columns.mapInArrow(_partial_counts, "lang string, kind string, item string, n long")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
    )
    counts = materialise(counts)
    totals = counts.where("kind = 'w'").groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= LANGUAGE_WORDS)
    # most words are rare whatever the language, and only common ones are joined and listed
    often = counts.where((F.col("kind") == "c") | (F.col("n") >= WORD_SHARE * LANGUAGE_WORDS))
    common = often.join(totals, "lang").where((F.col("kind") == "c") | (F.col("n") >= WORD_SHARE * F.col("total")))
    items = F.collect_list(F.struct("kind", "item", "n"))  # at most 1 / WORD_SHARE words
    bucket = F.crc32(F.col("lang").cast("binary")) % BUCKETS
    folder = new_stage(docs.sparkSession)
    common.groupBy("lang", "total").agg(items.alias("items")).withColumn("bucket", bucket).write.partitionBy("bucket").parquet(folder)
    return folder


@lru_cache(maxsize=256)
def reference(folder: str, lang: str) -> Reference | None:
    """The reference of a language, if it has one."""
    system, root = open_uri(folder)
    chosen = fs.FileSelector(f"{root}/bucket={zlib.crc32(lang.encode()) % BUCKETS}", allow_not_found=True)
    for found in system.get_file_info(chosen):
        if found.base_name.endswith(".parquet"):
            with system.open_input_file(found.path) as file:
                rows = pq.ParquetFile(file).read(columns=["lang", "total", "items"]).to_pylist()
            for row in rows:
                if row["lang"] == lang:
                    words, classes = ({x["item"]: x["n"] for x in row["items"] if x["kind"] == k} for k in "wc")
                    return _reference(lang, row["total"], words, classes)
    return None


def _reference(name: str, total: int, words: dict[str, int], classes: dict[str, int]) -> Reference:
    chars = np.array([classes.get(str(i), 0) for i in range(CLASSES)], float)
    listed = sorted(words)
    shares = np.array([*(words[w] for w in listed), total - sum(words.values())], float)
    return Reference(name, chars / chars.sum(), [w.encode() for w in listed], shares / total)


def distance(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The Jensen-Shannon distance of each row of shares to the reference, to 9 places."""
    middle = (rows + reference) / 2

    def relative(p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)

    both = relative(rows) + relative(np.broadcast_to(reference, rows.shape))
    return np.round(np.sqrt(np.clip(both / 2, 0, 1)), 9)


VERDICTS = (
    f"{COUNTS}, char_distance double, word_distance double, judged_by string, base_failed boolean, kept boolean"
)


def judge(texts: list[bytes | None], ref: Reference | None) -> dict[str, list]:
    """The columns of ``VERDICTS`` for texts of one language."""
    counts = [base_counts(t) for t in texts]
    failed = [base_failed(c[0], c[4]) for c in counts]
    names = [f.split()[0] for f in COUNTS.split(", ")]
    out: dict[str, list] = {n: [c[i] for c in counts] for i, n in enumerate(names)}
    n = len(texts)
    chars, words = np.full(n, np.nan), np.full(n, np.nan)
    judged = [i for i in range(n) if counts[i][0] > 0] if ref is not None else []
    if judged:
        shares = np.array([class_counts(texts[i]) for i in judged], float)
        chars[judged] = distance(shares / shares.sum(axis=1, keepdims=True), ref.classes)
        bags = [Counter(plain_words(texts[i])) for i in judged]
        totals = np.array([max(1, b.total()) for b in bags], float)[:, None]
        known = np.array([[b[w] for w in ref.words] for b in bags], float).reshape(len(bags), -1)
        known = np.hstack([known, totals - known.sum(axis=1, keepdims=True)]) / totals
        words[judged] = np.where([b.total() == 0 for b in bags], 1.0, distance(known, ref.shares))
    out["char_distance"] = [None if np.isnan(c) else float(c) for c in chars]
    out["word_distance"] = [None if np.isnan(c) else float(c) for c in words]
    out["judged_by"] = [ref.lang if ref is not None and not np.isnan(c) else None for c in chars]
    out["base_failed"] = failed
    out["kept"] = [
        not failed[i]
        and not (n_words >= CHAR_MIN_WORDS and chars[i] > CHAR_LIMIT)
        and not (n_words >= WORD_MIN_WORDS and words[i] > word_limit(n_words))
        for i, n_words in enumerate(out["n_words"])
    ]
    return out


def assess(docs: DataFrame, folder: str | None = None, text: str = "text", lang: str = "lang", keep=None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the columns of ``VERDICTS``, row by row. ``folder``:
    references of other documents, instead of their own."""
    folder = folder or references(docs, text, lang)
    added = [f.split()[0] for f in VERDICTS.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    code = F.col(lang).cast("string").alias("code")
    rows = docs.select(F.col(text).alias("text"), rest_of(kept, text).alias("doc"), code)
    texts = ["text"] if text in kept else []  # a text goes through Python once

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, codes = as_bytes(batch.column(0)), batch.column(2).to_pylist()
            found: dict[str, list] = {n: [None] * len(data) for n in added}
            for name in dict.fromkeys(codes):
                own = [i for i, c in enumerate(codes) if c == name]
                judged = judge([data[i] for i in own], None if name is None else reference(folder, name))
                for n, values in judged.items():
                    for i, value in zip(own, values, strict=True):
                        found[n][i] = value
            columns = [batch.column(c) for c in [*texts, "doc"]]
            columns += [pa.array(found[n], _ARROW[t]) for n, t in map(str.split, VERDICTS.split(", "))]
            yield pa.RecordBatch.from_arrays(columns, [*texts, "doc", *added])

    columns = [F.col("text").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in kept]
    return rows.mapInArrow(verdicts, schema_of(rows, [*texts, "doc"], VERDICTS)).select(*columns, *added)


_ARROW = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
