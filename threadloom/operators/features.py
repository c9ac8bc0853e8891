"""Vocabularies, padded id sequences, TF-IDF features and label codes."""

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import constants as K
from threadloom.functions import porter
from threadloom.functions import text as X
from threadloom.functions.arrays import HELD, Counts, Places
from threadloom.session import materialise

#: Terms in a summary of frequent ones; tasks hold, and broadcasts are, at most twice as many.
COUNTERS = 1 << 17
#: Rows of a batch that are looked at together.
_ROWS = 1 << 10


def word_column(text, spaced: bool = False, stop_words=K.STOP_WORDS) -> Column:
    """Words of the normalised text without stop words."""
    found = X.spaced_tokens(text) if spaced else X.tokens(text)
    return X.remove_stopwords(found, stop_words)


def stemmed(df: DataFrame, words: str) -> DataFrame:
    """``df`` with the words of an array column replaced by their stems; null becomes empty.

    Rows stay where they are: an Arrow batch stems each of its distinct words once.
    """
    none = F.array().cast("array<string>")
    return df.withColumn(words, F.coalesce(porter.stem_words(words), none))


def exploded(df: DataFrame, terms: Column) -> DataFrame:
    """One row per term. The outer form keeps the optimizer from evaluating the array twice
    (once more for a filter on its size)."""
    return df.select(F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def term_counts(df: DataFrame, terms: str) -> DataFrame:
    """Corpus frequency per term of an array column."""
    return exploded(df, F.col(terms)).groupBy("term").agg(F.count("*").alias("tf"))


def top_terms(df: DataFrame, terms: str, n: int) -> DataFrame:
    """The ``n`` most frequent terms; ties by name."""
    return term_counts(df, terms).orderBy(F.desc("tf"), "term").limit(n)


class Summary:
    """Lower bounds of the counts of frequent terms, and how much any term's count may lack.

    When more than twice ``size`` terms are held, the count of the next after the ``size`` most frequent is
    taken from all, and terms without any left go. Each such step removes at least ``size`` times
    what it adds to ``error``, so the error stays below the number of terms seen over ``size``.
    Summaries merge by adding counts and errors.
    """

    def __init__(self, size: int):
        self.size, self.counts, self.error = size, Counter(), 0

    def add(self, terms: Iterable[str]) -> None:
        self.counts.update(terms)
        if len(self.counts) > 2 * self.size:
            cut = int(np.partition(np.fromiter(self.counts.values(), np.int64), -self.size - 1)[-self.size - 1])
            self.counts = Counter({t: n - cut for t, n in self.counts.items() if n > cut})
            self.error += cut


def _summaries(df: DataFrame, words: str, ngram_range: tuple[int, int], size: int) -> DataFrame:
    """(term, low) of each task's summary of n-grams; the row without a term holds its error."""
    shortest, longest = ngram_range

    def rows(summary: Summary) -> pa.RecordBatch:
        terms, counts = [*summary.counts, None], [*summary.counts.values(), summary.error]
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["term", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                for n in range(shortest, longest + 1):
                    parts = [(found or [])[k:] for k in range(n)]
                    summary.add(found or [] if n == 1 else map(" ".join, zip(*parts, strict=False)))
        yield rows(summary)

    return df.select(words).mapInArrow(run, "term string, low long")


def _word_ids(lists: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word of some lists: its row, its place in ``words`` (-1: not there) and the words from it to the end of its list."""
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = pc.fill_null(pc.index_in(lists.flatten(), words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    return rows, ids, np.cumsum(lengths)[rows] - np.arange(len(ids))


def _gram_keys(ids: np.ndarray, left: np.ndarray, base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams of known words begin, and their numbers: the words' places as digits."""
    known = left >= length
    for k in range(length):
        known[: len(ids) - k] &= ids[k:] >= 0
    at = np.flatnonzero(known)
    keys = np.zeros(len(at), np.uint64)
    for k in range(length):
        keys = keys * np.uint64(base) + ids[at + k].astype(np.uint64)
    return at, keys


def _gram_texts(keys: np.ndarray, words: pa.Array, base: int, length: int) -> pa.Array:
    """The n-grams with the given numbers."""
    parts = []
    for _ in range(length):
        parts.append(words.take(pa.array((keys % np.uint64(base)).astype(np.int64))))
        keys = keys // np.uint64(base)
    return pc.binary_join_element_wise(*parts[::-1], " ")


def _known_grams(df: DataFrame, words: str, known: pa.Array, length: int, parts: np.ndarray | None) -> DataFrame:
    """(term, tf) of the n-grams of known words, whose head and tail are among ``parts``."""
    base = max(2, len(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, frequent = Counts(), None if parts is None else Places(parts)

        def rows() -> pa.RecordBatch:
            keys, found = counts.merged()
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(found, pa.int64())], ["key", "tf"])

        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                _, ids, left = _word_ids(batch.column(0).slice(start, _ROWS), known)
                if frequent is None:
                    keys = _gram_keys(ids, left, base, length)[1]
                else:
                    at, shorter = _gram_keys(ids, left, base, length - 1)
                    both = np.zeros(len(ids) + 1, bool)
                    both[at] = frequent.find(shorter) < len(parts)
                    ends = both[:-1] & both[1:] & (left >= length)
                    begin = np.flatnonzero(ends)
                    keys = np.zeros(len(begin), np.uint64)
                    for k in range(length):
                        keys = keys * np.uint64(base) + ids[begin + k].astype(np.uint64)
                counts.add(keys)
                if counts.held > HELD and len(counts.parts) == 1:  # merged, and still many
                    yield rows()
                    counts = Counts()
        yield rows()

    return df.select(words).mapInArrow(run, "key long, tf long").groupBy("key").agg(F.sum("tf").alias("tf"))


def top_ngrams(df: DataFrame, words: str, n: int, ngram_range=K.NGRAM_RANGE) -> DataFrame:
    """The ``n`` most frequent n-grams of a word array column (words without spaces); ties by name.

    The same rows as ``top_terms`` over all n-grams, without shuffling all of them. Once ``n`` terms are known, a further
    term must reach the lowest of their frequencies, and neither must a part of it be rarer. So words are counted first; the frequent ones,
    at most ``COUNTERS``, get numbers, and tasks count longer n-grams of them as numbers, with a frequent head and tail.
    Where more words are frequent, ``_top_by_summaries`` counts.
    """
    return _top_ngrams(materialise(df.select(words)), words, n, ngram_range)


def _top_ngrams(rows: DataFrame, words: str, n: int, ngram_range=K.NGRAM_RANGE) -> DataFrame:
    """``top_ngrams`` of a written table."""
    shortest, longest = ngram_range
    counts = materialise(exploded(rows, F.col(words)).groupBy("term").agg(F.count("*").alias("tf")))
    tables = [counts] if shortest == 1 else []

    def lowest() -> int:
        if not tables:
            return 1
        best = reduce(DataFrame.unionByName, tables).orderBy(F.desc("tf")).limit(n)
        least = best.agg(F.count("*").alias("terms"), F.min("tf").alias("tf")).first()
        return least["tf"] if least["terms"] >= n else 1

    frequent = counts.where(F.col("tf") >= lowest()).select("term")
    found = frequent.limit(COUNTERS + 1).toArrow().column("term").to_pylist()  # at most COUNTERS + 1 rows
    if len(found) > COUNTERS or max(2, len(found)) ** longest >= 1 << 63:
        return _top_by_summaries(rows, words, n, ngram_range)
    known = pa.array(sorted(found), pa.string())
    base, parts = max(2, len(known)), None
    for length in range(2, longest + 1):
        grams = materialise(_known_grams(rows, words, known, length, parts).where(F.col("tf") >= lowest()))

        def named(batches: Iterator[pa.RecordBatch], length: int = length) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                terms = _gram_texts(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64), known, base, length)
                yield pa.RecordBatch.from_arrays([terms, batch.column(1)], ["term", "tf"])

        if length >= shortest:
            tables.append(materialise(grams.mapInArrow(named, "term string, tf long")))
        if length < longest:
            few = grams.where(F.col("tf") >= lowest()).select("key").limit(2 * COUNTERS + 1).toArrow().column("key")
            parts = few.to_numpy().astype(np.uint64) if len(few) <= 2 * COUNTERS else None
    return reduce(DataFrame.unionByName, tables).orderBy(F.desc("tf"), "term").limit(n)


def _top_by_summaries(df: DataFrame, words: str, n: int, ngram_range=K.NGRAM_RANGE) -> DataFrame:
    """``top_ngrams`` for any number of frequent words.

    Each task keeps a summary of at most 2 * ``COUNTERS``
    n-grams; the merged one bounds every count from both sides. The n-th largest lower bound is what a further
    term must reach, so where it is above the error only terms that may reach it are counted, exactly, in a second pass. Where the bound proves
    nothing, or too many terms are left, n-grams are counted length by length (``_top_by_parts``).
    """
    merged = materialise(_summaries(df, words, ngram_range, COUNTERS).groupBy("term").agg(F.sum("low").alias("low")))
    error = merged.where("term is null").first()
    error = error["low"] if error else 0
    known = merged.where("term is not null")
    if error == 0:  # no task left anything out
        return known.select("term", F.col("low").alias("tf")).orderBy(F.desc("tf"), "term").limit(n)
    least = known.orderBy(F.desc("low")).limit(n).agg(F.count("*").alias("terms"), F.min("low").alias("low")).first()
    if least["terms"] < n or least["low"] <= error:
        return _top_by_parts(df, words, n, ngram_range)
    candidates = materialise(known.where(F.col("low") + error >= least["low"]).select("term"))
    if candidates.count() > 2 * COUNTERS:
        return _top_by_parts(df, words, n, ngram_range)
    lengths = range(ngram_range[0], ngram_range[1] + 1)
    grams = exploded(df, F.concat(*[X.ngrams(words, k) if k > 1 else F.col(words) for k in lengths]))
    counted = grams.join(F.broadcast(candidates), "term").groupBy("term").agg(F.count("*").alias("tf"))  # 2 * COUNTERS rows
    return counted.orderBy(F.desc("tf"), "term").limit(n)


def _top_by_parts(df: DataFrame, words: str, n: int, ngram_range=K.NGRAM_RANGE) -> DataFrame:
    """``top_ngrams`` without a summary.

    Once ``n`` terms are known, a further term must reach the lowest of their frequencies, and a longer
    n-gram is never more frequent than its head and tail. So each length counts only n-grams whose head and tail are frequent
    enough. The set of those is a written table, and the plan picks the semi-joins by its size.
    """
    shortest, longest = ngram_range
    floor, frequent, tables = 1, None, []
    for length in range(shortest, longest + 1):
        found = _grams_with_parts(df, words, length)
        if frequent is not None:
            for part in ("head", "tail"):
                known = frequent.withColumnRenamed("term", part)
                found = found.join(known, part, "left_semi")
        counts = found.groupBy("term").agg(F.count("*").alias("tf")).where(F.col("tf") >= floor)
        tables.append(materialise(counts))
        best = reduce(DataFrame.unionByName, tables).orderBy(F.desc("tf"), "term").limit(n)
        if length < longest:
            lowest = best.agg(F.count("*").alias("terms"), F.min("tf").alias("tf")).first()
            floor = lowest["tf"] if lowest["terms"] >= n else 1
            frequent = materialise(tables[-1].where(F.col("tf") >= floor).select("term"))
    return best


def _grams_with_parts(df: DataFrame, words: str, length: int) -> DataFrame:
    """One row per n-gram with the n-gram that lacks its last word and its first word."""
    if length == 1:
        return exploded(df, F.col(words))
    shorter = df.select(words, X.ngrams(words, length - 1).alias("_short"))
    heads = F.slice("_short", F.lit(1), F.greatest(F.size("_short") - F.lit(1), F.lit(0)))
    grams = F.transform(
        heads,
        lambda head, i: F.struct(
            head.alias("head"),
            F.get(F.col("_short"), i + F.lit(1)).alias("tail"),
            F.concat_ws(" ", head, F.get(F.col(words), i + F.lit(length - 1))).alias("term"),
        ),
    )
    rows = shorter.select(F.explode_outer(grams).alias("gram")).select("gram.*")
    return rows.where(F.col("term").isNotNull())


def vocabulary(df: DataFrame, terms: str, size: int = K.MAX_VOCABULARY) -> DataFrame:
    """(term, idx, tf) with the reserved pad and unknown entries in front.

    The index window has no partition key, but it sees at most ``size`` rows.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("tf"), "term")
    top = top_terms(df, terms, size - 2).select(
        "term", (F.row_number().over(order) + F.lit(K.UNKNOWN_ID)).alias("idx"), "tf"
    )
    reserved = df.sparkSession.createDataFrame(
        [(K.PAD_TOKEN, K.PAD_ID, 0), (K.UNKNOWN_TOKEN, K.UNKNOWN_ID, 0)],
        "term string, idx int, tf bigint",
    )
    return reserved.unionByName(top)


def encode_sequences(
    df: DataFrame, key: str, terms: str, vocab: DataFrame, length: int = K.SEQUENCE_LENGTH
) -> DataFrame:
    """The first ``length`` words of each row as ids, unknown as 1, padded with 0.

    At most ``length`` words of a row are looked up and gathered again.
    """
    head = df.select(key, F.slice(terms, 1, length).alias("_head"))
    words = head.select(key, F.posexplode_outer("_head").alias("_pos", "_term"))
    lookup = vocab.select(F.col("term").alias("_term"), "idx")
    entry = F.when(
        F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("idx", F.lit(K.UNKNOWN_ID)).alias("idx"))
    )
    listed = words.join(lookup, "_term", "left").groupBy(key).agg(F.collect_list(entry).alias("_list"))
    ids = F.transform(F.array_sort("_list"), lambda e: e["idx"])
    padded = F.concat(ids, F.array_repeat(F.lit(K.PAD_ID), F.lit(length) - F.size("_list")))
    return listed.select(key, padded.alias("ids"))


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """Labels in alphabetical order with codes from 0; the window sees distinct labels only."""
    order = Window.partitionBy(F.lit(0)).orderBy(label)
    distinct = df.where(F.col(label).isNotNull()).select(label).distinct()
    return distinct.withColumn("code", F.row_number().over(order) - 1)


def encode_labels(df: DataFrame, label: str) -> DataFrame:
    """Add the code of each label."""
    return df.join(materialise(label_codes(df, label)), label)


def idf_weight(rows, df) -> Column:
    """Smooth inverse document frequency, ``ln((1 + n) / (1 + df)) + 1``."""
    return F.log((rows + F.lit(1.0)) / (df + F.lit(1.0))) + F.lit(1.0)


def idf_table(df: DataFrame, terms: str) -> DataFrame:
    """Document frequency and weight per term."""
    rows = df.agg(F.count("*")).scalar()
    counts = exploded(df, F.array_distinct(terms)).groupBy("term").agg(F.count("*").alias("df"))
    return counts.withColumn("idf", idf_weight(rows, F.col("df")))


@dataclass(frozen=True)
class Tfidf:
    """A fitted vocabulary and the row-wise transformers that use it."""

    terms: list[str]
    pipeline: PipelineModel
    words: str

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(with_known_terms(df, self.words, self.pipeline))

    def weights(self, df: DataFrame, key: str) -> DataFrame:
        """(key, term, weight) of the non-zero features; stays in the scan stage."""
        terms, vocabulary, idf = self.terms, _Vocabulary(self.terms), self.pipeline.stages[1].getScalingVec().toArray()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = pa.array(terms, pa.string())
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(start, _ROWS)
                    rows, held, counts = vocabulary.counts(part.column(1))
                    weight = counts * idf[held]
                    norm = np.sqrt(np.bincount(rows, weight**2, part.num_rows))
                    columns = [part.column(0).take(pa.array(rows)), names.take(pa.array(held)), pa.array(weight / norm[rows])]
                    yield pa.RecordBatch.from_arrays(columns, [key, "term", "w"])

        schema = T.StructType([df.schema[key], T.StructField("term", T.StringType()), T.StructField("w", T.DoubleType())])
        return df.select(key, self.words).mapInArrow(run, schema)


class _Vocabulary:
    """The terms of a vocabulary as numbers, length by length."""

    def __init__(self, terms: list[str]):
        split = [t.split(" ") for t in terms]
        self.size, words = len(terms), sorted({w for parts in split for w in parts})
        self.words, self.base, self.by_length = pa.array(words, pa.string()), max(2, len(words)), {}
        place = {w: k for k, w in enumerate(words)}
        for length in sorted({len(parts) for parts in split}):
            own = [k for k, parts in enumerate(split) if len(parts) == length]
            keys = np.zeros(len(own), np.uint64)
            for at in range(length):
                keys = keys * np.uint64(self.base) + np.array([place[split[k][at]] for k in own], np.uint64)
            self.by_length[length] = (Places(keys), np.array([*own, -1]))

    def found(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row and term of all terms in lists of words."""
        rows, ids, left = _word_ids(lists, self.words)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for length, (places, terms) in self.by_length.items():
            at, keys = _gram_keys(ids, left, self.base, length)
            term = terms[places.find(keys)]
            found.append((rows[at][term >= 0], term[term >= 0]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def counts(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of the terms in lists of words."""
        rows, terms = self.found(lists)
        entries, counts = np.unique(rows * self.size + terms, return_counts=True)
        return entries // max(1, self.size), entries % max(1, self.size), counts


def known_terms(words: str, terms: list[str]) -> Column:
    """The n-grams of a word array column that are in a vocabulary, each as often as it occurs; null becomes empty."""
    vocabulary = _Vocabulary(terms)

    def run(lists: pa.Array) -> pa.Array:
        names, sizes, parts = pa.array(terms, pa.string()), [], []
        for start in range(0, len(lists), _ROWS):
            part = lists.slice(start, _ROWS)
            rows, found = vocabulary.found(part)
            sizes.append(np.bincount(rows, minlength=len(part)))
            parts.append(found[np.argsort(rows, kind="stable")])
        found = np.concatenate([*parts, np.zeros(0, np.int64)])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(found, pa.int64())))

    return F.arrow_udf(run, T.ArrayType(T.StringType()))(F.col(words))


def with_known_terms(df: DataFrame, words: str, pipeline: PipelineModel) -> DataFrame:
    """``df`` with the terms that the first stage of a feature pipeline counts, from a word array column, and no others."""
    counter = pipeline.stages[0]
    return df.withColumn(counter.getInputCol(), known_terms(words, counter.vocabulary))


def _holders(df: DataFrame, words: str, terms: list[str]) -> np.ndarray:
    """The number of rows that hold each term of a vocabulary."""
    vocabulary = _Vocabulary(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                total += np.bincount(vocabulary.counts(batch.column(0).slice(start, _ROWS))[1], minlength=len(terms))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["i", "n"])

    out = np.zeros(len(terms), np.int64)
    for row in df.select(words).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[row["i"]] = row["n"]
    return out


def fit_tfidf(df: DataFrame, words: str, terms: str, size: int = K.MAX_VOCABULARY) -> Tfidf:
    """TF-IDF over the n-grams (column ``terms``) of a word array column ``words``:
    capped vocabulary, smooth idf + 1, unit row length.

    The driver holds the vocabulary and one weight per entry, both capped by ``size``.
    Document frequencies are counted per term, for the terms of the vocabulary only.
    """
    written = materialise(df.select(words))
    vocab = [r["term"] for r in _top_ngrams(written, words, size).collect()]
    rows, holding = written.count(), _holders(written, words, vocab)
    counter = CountVectorizerModel.from_vocabulary(vocab, inputCol=terms, outputCol="tf")
    idf = np.log((1.0 + rows) / (1.0 + holding)) + 1.0
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="tfidf")
    unit = Normalizer(p=2.0, inputCol="tfidf", outputCol="features")
    return Tfidf(vocab, PipelineModel([counter, scale, unit]), words)
