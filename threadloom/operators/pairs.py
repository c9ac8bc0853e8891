"""Reply pairs: comments joined to the comment or submission they answer.

No side is broadcast by hint: both grow with the dump. A submission that draws a third of
all replies is split by the adaptive skew join, for which the joins are kept as plain
inner/left equi-joins whose inputs come straight from a shuffle.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import prompts

PAIR_COLUMNS = ("id", "pair_type", "instruction", "input", "output", "subreddit")


def latest_by_id(df: DataFrame, key: str, position: str) -> DataFrame:
    """The last row per key wins. The rank filter is applied before the shuffle as well."""
    order = Window.partitionBy(key).orderBy(F.col(position).desc())
    ranked = df.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank")


def _reference(c: str):
    """The id part of a full name such as ``t1_abc``."""
    return F.get(F.split(F.col(c), "_"), F.lit(1))


def _replies(comments: DataFrame, prefix: str) -> DataFrame:
    return comments.where(F.col("parent_id").startswith(prefix)).select(
        "id",
        "subreddit",
        F.col("body").alias("output"),
        _reference("parent_id").alias("parent"),
        F.when(F.col("link_id").startswith("t3_"), _reference("link_id")).alias("link"),
    )


def comment_pairs(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Replies to comments; the title of the thread is added where it is known."""
    parents = comments.select(F.col("id").alias("parent"), F.col("body").alias("input"))
    titles = submissions.select(F.col("id").alias("link"), F.col("title").alias("context"))
    joined = _replies(comments, "t1_").join(parents, "parent").join(titles, "link", "left")
    return _pair(joined, "comment")


def submission_pairs(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Replies to submissions: the selftext is the input, or the title where it is empty."""
    has_text = F.length("selftext") > 0
    parents = submissions.select(
        F.col("id").alias("parent"),
        F.when(has_text, F.col("selftext")).otherwise(F.col("title")).alias("input"),
        F.when(has_text, F.col("title")).alias("context"),
    )
    return _pair(_replies(comments, "t3_").join(parents, "parent"), "submission")


def _pair(joined: DataFrame, pair_type: str) -> DataFrame:
    return joined.select(
        "id",
        F.lit(pair_type).alias("pair_type"),
        prompts.reply_instruction("subreddit", "context").alias("instruction"),
        "input",
        "output",
        "subreddit",
    )


def reply_pairs(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    return comment_pairs(comments, submissions).unionByName(submission_pairs(comments, submissions))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Pairs by type and the total (type ``all``)."""
    counts = pairs.rollup("pair_type").agg(F.count("*").alias("pairs"))
    return counts.select(F.coalesce("pair_type", F.lit("all")).alias("pair_type"), "pairs")
