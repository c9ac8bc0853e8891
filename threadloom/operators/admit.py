"""Admission of raw forum rows: which comments and submissions are kept, and why not."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import predicates as P
from threadloom.functions import text as X
from threadloom.operators import language
from threadloom.session import materialise, place


def comment_candidates(comments: DataFrame) -> DataFrame:
    """Rows that pass every test but the language test; the tests run on raw columns."""
    return comments.where(P.passes(P.comment_rejections()))


def submission_candidates(submissions: DataFrame) -> DataFrame:
    return submissions.where(P.passes(P.submission_rejections()))


def keep_ascii(df: DataFrame, text: Column) -> DataFrame:
    """The language test for English without a model: only ASCII rows pass."""
    return df.where(P.is_ascii(text))


def keep_english(df: DataFrame, text: Column, model: language.LanguageModel) -> DataFrame:
    """ASCII rows pass at once; only the others are scored by the language model.

    Every row is tested on its own, whatever its id, and stays where it is.
    """
    if model.packed is None:
        return _keep_english_by_joins(df, text, model)
    ascii_text = P.is_ascii(text)
    labelled = model.with_label(df, F.when(~ascii_text, text), "_lang")
    return labelled.where(ascii_text | (F.col("_lang") == "en")).select(*df.columns)


def _keep_english_by_joins(df: DataFrame, text: Column, model: language.LanguageModel) -> DataFrame:
    """With a model too large for a task. The rows are written first, because they are used three
    times and come out of a selective filter."""
    columns = df.columns
    written = materialise(df)
    other = written.where(~P.is_ascii(text)).select(*columns, place().alias("_place"))
    found = model.predict(other, "_place", text).where(F.col("lang") == "en").select("_place")
    english = other.join(found, "_place", "left_semi").select(*columns)
    return keep_ascii(written, text).select(*columns).unionByName(english)


def admit_comments(comments: DataFrame, model: language.LanguageModel) -> DataFrame:
    return keep_english(comment_candidates(comments), F.col("body"), model)


def admit_submissions(submissions: DataFrame, model: language.LanguageModel) -> DataFrame:
    return keep_english(submission_candidates(submissions), P.title_and_body("title", "selftext"), model)


def admit_ascii_comments(comments: DataFrame) -> DataFrame:
    """Admission where only ASCII texts count as English."""
    return keep_ascii(comment_candidates(comments), F.col("body"))


def with_comment_reason(comments: DataFrame) -> DataFrame:
    """Annotate each row with the first test it fails (null: admitted)."""
    return comments.withColumn("reason", P.first_reason(P.comment_rejections()))


def with_submission_reason(submissions: DataFrame) -> DataFrame:
    return submissions.withColumn("reason", P.first_reason(P.submission_rejections()))


def stage_counters(comments: DataFrame) -> DataFrame:
    """Processed, kept, dropped and changed rows of the admission and polish stages in one pass."""
    cleaned = X.clean_comment("body")
    staged = with_comment_reason(comments).select("reason", cleaned.alias("cleaned"))
    polished = X.polish("cleaned")
    admitted = F.col("reason").isNull()
    return staged.select(
        admitted.alias("admitted"),
        (F.length(polished) < P.K.POLISHED_BODY_MIN).alias("short"),
        (polished != F.col("cleaned")).alias("changed"),
    ).agg(
        F.count("*").alias("processed"),
        F.count_if("admitted").alias("admitted"),
        F.count_if(F.col("admitted") & F.col("short")).alias("dropped"),
        F.count_if(F.col("admitted") & ~F.col("short")).alias("kept"),
        F.count_if(F.col("admitted") & ~F.col("short") & F.col("changed")).alias("cleaned"),
    )
