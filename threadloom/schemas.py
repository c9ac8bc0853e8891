"""Explicit schemas; only fields that are read are listed, so readers prune the rest."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


RAW_COMMENTS = T.StructType(
    _strings("id", "parent_id", "link_id", "subreddit", "author", "body")
    + [T.StructField("score", T.LongType())]
)
RAW_SUBMISSIONS = T.StructType(
    _strings("id", "subreddit", "author", "title", "selftext")
    + [T.StructField("score", T.LongType())]
)
INSTRUCTION_ROWS = T.StructType(_strings("instruction", "input", "output", "subreddit"))
SOURCED_ROWS = T.StructType(_strings("instruction", "output", "source"))
MESSAGES = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that receives lines the JSON reader cannot parse."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
