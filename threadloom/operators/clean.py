"""Cleaning stages over admitted rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import predicates as P
from threadloom.functions import text as X

COMMENT_KEYS = ("id", "parent_id", "link_id", "subreddit", "body", "score")


def clean_comments(comments: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return comments.withColumn("body", X.clean_comment("body")).select(*COMMENT_KEYS, *keep)


def polish_comments(comments: DataFrame) -> DataFrame:
    """Second pass; rows whose polished body is too short are dropped."""
    return comments.withColumn("body", X.polish("body")).where(
        F.length("body") >= K.POLISHED_BODY_MIN
    )


def clean_submissions(submissions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean title and selftext; the title is checked again before it is stripped."""
    return submissions.where(P.survives_title_recheck("title")).select(
        "id",
        default_forum("subreddit").alias("subreddit"),
        X.clean_title("title").alias("title"),
        X.clean_selftext("selftext").alias("selftext"),
        "score",
        *keep,
    )


def default_forum(c: str) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(K.DEFAULT_FORUM))
