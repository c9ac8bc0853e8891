"""Small tables with the awkward cases every operator must take."""

from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs(spark, texts, langs=None, ids=None):
    rows = [
        Row(
            doc_id=i if ids is None else ids[i],
            text=t,
            lang=None if langs is None else langs[i],
            source="s",
            n_chars=None if t is None else len(t),
        )
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


LONG = " ".join(f"word{i % 977} of text{i}" for i in range(40_000))
ODD_TEXTS = [None, "", " \n\t ", "a", "Ünïcödé ÉÈ ß 漢字 \U0001f600", "same same", "same same", LONG, "\n\n\n", "x" * 5000]
ODD_IDS = [0, None, 2, None, 4, 5, 5, 7, None, None]


def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    from pyspark.sql import functions as F

    df = docs(spark, ODD_TEXTS, ids=ODD_IDS)
    clashing = (
        "row doc key digest shard slot n_words kept n_lines spans items lang_pred score tokens_before "
        "sequence_id offset licenses class_id _text _metadata hash number places"
    )
    return df.withColumns({c: F.lit(f"own {c}") for c in [*clashing.split(), "a b", "0", "x:y"]})


def empty(spark):
    return spark.createDataFrame([], DOCS)
