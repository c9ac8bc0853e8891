"""Language test: multinomial Naive Bayes over character trigrams.

With ``n(c, g)`` the count of gram ``g`` in class ``c``, ``V`` the number of different
grams and ``N(c)`` the class total, the add-one score of a text with ``k(g)`` grams is

    score(c) = sum_g k(g) * ln(n(c, g) + 1)  -  K * ln(N(c) + V),   K = sum_g k(g)

so grams that a class has never seen add nothing, and ``K`` follows from the text length.

A model of at most ``IN_TASK`` grams is one file of sorted arrays that each task loads; a row's score is computed where
the row lies. A larger one is a table that counts of grams are joined to.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import text as X
from threadloom.functions.arrays import HELD, Counts, Places
from threadloom.session import materialise, new_stage, open_uri

GRAM = 3
#: Grams that a task may hold: about 8 bytes each, and 8 for every class.
IN_TASK = 1 << 20
#: Bytes of text, or characters of a longer text, that are looked up at once.
_PIECE = 1 << 18

def grams(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """One row per trigram occurrence of the lower-cased text.

    Plain ``explode`` would make the optimizer add a filter on the array size, and so
    extract the grams twice; the outer form with a filter on its result does it once.
    """
    found = F.explode_outer(X.char_ngrams(F.lower(text), GRAM)).alias("gram")
    return df.select(*keep, found).where(F.col("gram").isNotNull())


def gram_keys(codes: np.ndarray) -> np.ndarray:
    """One number per trigram of a row of code points, 21 bits a character."""
    c = codes.astype(np.uint64)
    return c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]


def _texts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows: the first row, the lengths of the texts and their code points; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _PIECE, "right")) - 1)
        run = b"" if data is None else data.slice(ends[at], ends[to] - ends[at]).to_pybytes()
        yield at, lengths[at:to], np.frombuffer(run.decode("utf-8").encode("utf-32-le"), "<u4")
        at = to


def _text_grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The first row, rows per gram and numbers of the trigrams of runs of rows, piece by piece."""
    for first, lengths, codes in _texts(texts):
        rows, ends = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths)
        whole = np.ones(len(codes), bool)  # a gram begins here and ends in the same text
        for back in range(1, GRAM):
            whole[np.maximum(ends - back, 0)[ends >= back]] = False
        for at in range(0, len(codes) - GRAM + 1, _PIECE):
            kept = whole[at : at + _PIECE][: len(codes) - GRAM + 1 - at]
            yield first, rows[at : at + len(kept)][kept], gram_keys(codes[at : at + _PIECE + GRAM - 1])[kept]


def gram_texts(keys: np.ndarray) -> pa.Array:
    """The trigrams with the given numbers."""
    codes = np.stack([keys >> np.uint64(42), keys >> np.uint64(21), keys], 1) & np.uint64((1 << 21) - 1)
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([text[k : k + GRAM] for k in range(0, len(text), GRAM)], pa.string())


def profile(df: DataFrame, text: str, label: str) -> DataFrame:
    """Gram counts per class, summed up where the rows lie; few rows are shuffled."""
    kind = df.schema[label].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[object, Counts] = {}

        def rows(arrow: pa.DataType) -> Iterator[pa.RecordBatch]:
            for name, held in counts.items():
                keys, found = held.merged()
                columns = [pa.array([name] * len(keys), arrow), gram_texts(keys), pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [label, "gram", "n"])

        arrow = None
        for batch in batches:
            arrow = batch.column(0).type
            names = batch.column(0).dictionary_encode(null_encoding="encode")
            codes, values = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            for first, at, keys in _text_grams(batch.column(1)):
                of = codes[first + at]
                for code in np.unique(of).tolist():
                    counts.setdefault(values[code], Counts()).add(keys[of == code])
            if sum(c.held for c in counts.values()) > 2 * HELD:
                for held in counts.values():
                    held.merged()
                if sum(c.held for c in counts.values()) > HELD:
                    yield from rows(arrow)
                    counts.clear()
        if arrow is not None:
            yield from rows(arrow)

    schema = T.StructType([T.StructField(label, kind), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    counted = df.select(label, F.lower(text).alias("_text")).mapInArrow(run, schema)
    return counted.groupBy(label, "gram").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=2)
def _arrays(path: str, classes: int) -> tuple[Places, np.ndarray]:
    """The places of the grams of a packed model and their weights class by class; a last zero stands for all others."""
    system, name = open_uri(path)
    with system.open_input_stream(name, compression=None) as file:
        data = file.read()
    n = len(data) // (8 * (1 + classes))
    weights = np.zeros((classes, n + 1))
    weights[:, :n] = np.frombuffer(data, "<f8", offset=8 * n).reshape(n, classes).T
    return Places(np.frombuffer(data, "<u8", n).astype(np.uint64)), weights


def summed_weights(texts: pa.Array, places: Places, weights: np.ndarray) -> np.ndarray:
    """The sums of the weights of all trigrams of each text."""
    total = np.zeros((len(texts), len(weights)))
    for first, rows, keys in _text_grams(texts):
        if not len(keys):
            continue
        new = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        place = places.find(keys)
        for k, own in enumerate(weights):
            total[first + rows[new], k] += np.add.reduceat(own[place], new)
    return total


def _scorer(path: str, classes: int) -> Callable:
    """A column function: the number of grams of a text and its sums of weights; null for a null text."""

    def run(texts: pa.Array) -> pa.Array:
        grams = pc.subtract(pc.utf8_length(texts).cast(pa.int64()), GRAM - 1)
        none = pc.fill_null(pc.less(grams, 1), True)
        sums = summed_weights(texts, *_arrays(path, classes))
        ends = pa.array(np.arange(len(texts) + 1) * classes, pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(sums.ravel()), mask=none)
        return pa.StructArray.from_arrays([grams, lists], ["grams", "sums"])

    kind = T.StructType([T.StructField("grams", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])
    return F.arrow_udf(run, kind)


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` has one row per gram and one ``ln(n + 1)`` column per class."""

    weights: DataFrame
    classes: list[str]
    offsets: dict[str, float]

    @cached_property
    def packed(self) -> str | None:
        """The path of the model as one file; None if it has more than ``IN_TASK`` grams."""
        if self.weights.count() > IN_TASK:
            return None
        rows = self.weights.select("gram", *[f"w_{c}" for c in self.classes]).toArrow()
        grams = "".join(rows.column(0).to_pylist()).encode("utf-32-le", "replace")
        keys = gram_keys(np.frombuffer(grams, "<u4"))[::GRAM] if grams else np.zeros(0, np.uint64)
        order = np.argsort(keys)
        columns = [rows.column(k + 1).to_numpy() for k in range(len(self.classes))]
        path = new_stage(self.weights.sparkSession)
        system, name = open_uri(path)
        with system.open_output_stream(name, compression=None) as out:
            out.write(keys[order].astype("<u8").tobytes() + np.stack(columns, 1)[order].astype("<f8").tobytes())
        return path

    def _scores(self, grams: Column, sums: list[Column]) -> list[Column]:
        return [F.round(s - grams * F.lit(self.offsets[c]), 6).alias(f"s_{c}") for c, s in zip(self.classes, sums, strict=True)]

    def _best(self, scores: list[Column]) -> tuple[Column, Column]:
        """The class with the highest score, the first by name on a tie; and the score."""
        best = F.greatest(*scores)
        return F.coalesce(*[F.when(s == best, F.lit(c)) for c, s in zip(self.classes, scores, strict=True)]), best

    def score(self, df: DataFrame, key: str, text: Column) -> DataFrame:
        """Class scores per key; texts shorter than one gram give no row."""
        if self.packed is None:
            return self._joined(df, key, text)
        found = df.select(key, _scorer(self.packed, len(self.classes))(F.lower(text)).alias("_f")).where("_f.grams > 0")
        sums = [F.col("_f.sums")[k] for k in range(len(self.classes))]
        return found.select(key, F.col("_f.grams").alias("grams"), *self._scores(F.col("_f.grams"), sums))

    def _joined(self, df: DataFrame, key: str, text: Column) -> DataFrame:
        """The scores by joins: texts are dealt out by key once, grams are counted, joined to the
        weights and summed by that key."""
        dealt = df.select(key, text.alias("_text")).repartition(key)
        counted = grams(dealt, F.col("_text"), key).groupBy(key, "gram").agg(F.count("*").alias("k"))
        joined = counted.join(self.weights, "gram", "left")
        sums = [
            F.sum(F.col("k") * F.coalesce(F.col(f"w_{c}"), F.lit(0.0))).alias(f"s_{c}")
            for c in self.classes
        ]
        totals = joined.groupBy(key).agg(F.sum("k").alias("grams"), *sums)
        return totals.select(key, "grams", *self._scores(F.col("grams"), [F.col(f"s_{c}") for c in self.classes]))

    def predict(self, df: DataFrame, key: str, text: Column) -> DataFrame:
        """The class with the highest score per key, and the score."""
        label, best = self._best([F.col(f"s_{c}") for c in self.classes])
        return self.score(df, key, text).select(key, label.alias("lang"), best.alias("score"))

    def with_label(self, df: DataFrame, text: Column, name: str) -> DataFrame:
        """``df`` with the class of each row's text (null where it is null or shorter than a gram); the model must be packed."""
        if self.packed is None:
            raise ValueError(f"a model of more than {IN_TASK} grams has no packed form")
        found = df.withColumn("_f", _scorer(self.packed, len(self.classes))(F.lower(text)))
        sums = [F.get("_f.sums", k) for k in range(len(self.classes))]
        return found.withColumn(name, self._best(self._scores(F.col("_f.grams"), sums))[0]).drop("_f")


def fit(df: DataFrame, text: str, label: str, classes: list[str]) -> LanguageModel:
    """Train on labelled texts; ``classes`` are the labels to tell apart (two or more)."""
    classes = sorted(classes)
    counts = materialise(profile(df.where(F.col(label).isin(*classes)), text, label))
    totals = {r[label]: r["n"] for r in counts.groupBy(label).agg(F.sum("n").alias("n")).collect()}
    weights = counts.groupBy("gram").agg(
        *[
            F.log(F.sum(F.when(F.col(label) == c, F.col("n")).otherwise(0)) + F.lit(1)).alias(f"w_{c}")
            for c in classes
        ]
    )
    weights = materialise(weights)
    size = weights.count()
    return LanguageModel(weights, classes, {c: math.log(max(1, totals.get(c, 0) + size)) for c in classes})


def save(model: LanguageModel, path: str) -> None:
    """The weights as Parquet, the classes and their offsets as one JSON line each."""
    spark = model.weights.sparkSession
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")
    rows = [(c, model.offsets[c]) for c in model.classes]
    spark.createDataFrame(rows, "class string, offset double").write.mode("overwrite").json(f"{path}/classes")


def load(spark: SparkSession, path: str) -> LanguageModel:
    rows = spark.read.schema("class string, offset double").json(f"{path}/classes").collect()
    offsets = {r["class"]: r["offset"] for r in rows}
    return LanguageModel(spark.read.parquet(f"{path}/weights"), sorted(offsets), offsets)
