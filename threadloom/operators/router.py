"""Intent router on Spark ML, and its evaluation."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import text as X
from threadloom.operators import features
from threadloom.session import materialise


MAX_LABELS = 1000


def prepare(df: DataFrame, text: str, spaced: bool = False, stem: bool = True) -> DataFrame:
    """Add the columns ``words``, ``term_words`` (two or more word characters) and ``terms``
    (their n-grams); one normaliser serves training and scoring."""
    words = df.withColumn("words", features.word_column(text, spaced))
    if stem:
        words = features.stemmed(words, "words")
    joined = words.withColumn("term_words", X.word_terms(F.array_join("words", " ")))
    return joined.withColumn("terms", X.ngram_terms("term_words"))


@dataclass(frozen=True)
class Router:
    """A fitted model, the iterations it took, and whether it stopped by itself."""

    model: PipelineModel
    iterations: int
    converged: bool


def train(
    df: DataFrame,
    label: str,
    size: int = K.MAX_VOCABULARY,
    network: bool = False,
    max_iter: int = 50,
) -> Router:
    """Fit features and classifier on prepared rows with a label column.

    Default is multinomial logistic regression; ``network`` selects a feed-forward net with
    the hidden layers 64 and 32. Both aggregate gradients by tree, without a shuffle.
    ``max_iter`` bounds the iterations and so changes a fit that did not converge before.
    More than ``MAX_LABELS`` labels are an error, as the driver holds them.
    """
    if df.select(label).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    tfidf = features.fit_tfidf(df, "term_words", "terms", size)
    indexer = StringIndexer(inputCol=label, outputCol="code", stringOrderType="alphabetAsc").fit(df)
    if network:
        layers = [len(tfidf.terms), *K.HIDDEN_LAYERS, len(indexer.labels)]
        classifier = MultilayerPerceptronClassifier(layers=layers, labelCol="code", seed=42, maxIter=max_iter)
    else:
        classifier = LogisticRegression(family="multinomial", labelCol="code", maxIter=max_iter)
    rows = materialise(tfidf.transform(indexer.transform(df)).select("features", "code"))
    fitted = classifier.fit(rows)
    iterations = fitted.summary().totalIterations if network else fitted.summary.totalIterations
    back = IndexToString(inputCol="prediction", outputCol="label", labels=indexer.labels)
    model = PipelineModel([*tfidf.pipeline.stages, fitted, back])
    return Router(model, iterations, iterations < max_iter)


def score(model: PipelineModel, df: DataFrame, words: str | None = None) -> DataFrame:
    """Add the predicted label and its confidence (the highest class probability).

    Where the word array column of prepared rows is named, only terms of the vocabulary are made of it.
    """
    kept, rows = [F.col(f"`{c}`") for c in df.columns], df
    if words is not None:
        terms = model.stages[0].getInputCol()
        rows = features.with_known_terms(df.withColumn("_terms", F.col(terms)), words, model)
        kept = [F.col("_terms").alias(c) if c == terms else F.col(f"`{c}`") for c in df.columns]
    confidence = F.array_max(vector_to_array("probability"))
    scored = model.transform(rows).withColumn("confidence", confidence)
    return scored.select(*kept, "label", "confidence")


def accuracy(df: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Correct and total rows; labels are compared without case."""
    hit = F.upper(predicted) == F.upper(expected)
    totals = df.agg(F.count_if(hit).alias("correct"), F.count("*").alias("total"))
    return totals.withColumn("accuracy", X.percent(F.col("correct") / F.col("total")))


def confusion(df: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Rows per (expected, predicted)."""
    return df.groupBy(
        F.upper(expected).alias("expected"), F.upper(predicted).alias("predicted")
    ).agg(F.count("*").alias("rows"))


def evaluation_rows(df: DataFrame, text: str, predicted: str, expected: str) -> DataFrame:
    """A PASS/FAIL line per row with a 30-character preview."""
    p, e = F.upper(predicted), F.upper(expected)
    line = F.when(
        p == e, F.concat(F.lit("[PASS] "), X.preview(text), F.lit(" -> "), p)
    ).otherwise(
        F.concat(F.lit("[FAIL] "), X.preview(text), F.lit(" -> Pred: "), p, F.lit(" | Exp: "), e)
    )
    return df.withColumn("line", line)


def normaliser_skew(df: DataFrame, text: str) -> DataFrame:
    """Rows whose words differ between the two normalisers."""
    differs = X.tokens(text) != X.spaced_tokens(text)
    return df.agg(F.count("*").alias("rows"), F.count_if(differs).alias("skewed"))
