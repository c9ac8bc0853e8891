"""A corpus pipeline: documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of their documents, with changed texts and ``n_chars`` where lines or passages went.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontaminate, line_dedup, lsh_forest, packing, quality
from threadloom.session import materialise


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near a language reference."""
    return quality.assess(docs).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks of earlier ones; those of which no line is left go."""
    left = line_dedup.dedup(docs).where("n_removed = 0 or n_removed < n_lines")
    return _with_length(left, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return lsh_forest.one_per_group(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those of which no word is left go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, items, remove=True)
    left = found.where("size(spans) = 0 or text rlike '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]'")
    return _with_length(left, docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("packing", packed),
]

#: Packing and the diff of lines have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
