"""Public instruction tables brought into the row shape (instruction, input, output)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import prompts
from threadloom.functions import text as X


def source_table(spark: SparkSession, sources=K.MATH_SOURCES) -> DataFrame:
    """The known maths sources with their kind and instruction."""
    return spark.createDataFrame(list(sources), "source string, kind string, instruction string")


def with_math_instruction(df: DataFrame, sources=K.MATH_SOURCES) -> DataFrame:
    """Add kind and instruction by source; unknown sources keep a null kind.

    The lookup is a literal table of fixed length, so it is broadcast.
    """
    table = F.broadcast(source_table(df.sparkSession, sources).withColumnsRenamed(
        {"source": "_source", "instruction": "_instruction"}
    ))
    joined = df.join(table, prompts.canonical_source("source") == F.col("_source"), "left")
    return joined.drop("_source")


def math_rows(df: DataFrame, sources=K.MATH_SOURCES) -> DataFrame:
    """Sourced maths rows of known sources; program answers are wrapped as tool calls."""
    output = F.when(F.col("kind") == "PoT", X.wrap_tool_call("output")).otherwise(F.col("output"))
    return with_math_instruction(df, sources).where(F.col("kind").isNotNull()).select(
        *[c for c in df.columns if c not in ("instruction", "output", "source")],
        "kind",
        F.col("_instruction").alias("instruction"),
        F.col("instruction").alias("input"),
        output.alias("output"),
    )


def source_counts(df: DataFrame, sources=K.MATH_SOURCES) -> DataFrame:
    """Rows per kind, and the rows of unknown sources as kind ``excluded``."""
    kind = F.coalesce("kind", F.lit("excluded")).alias("kind")
    return with_math_instruction(df, sources).groupBy(kind).agg(F.count("*").alias("rows"))


def code_solution_rows(df: DataFrame) -> DataFrame:
    """(instruction, output): the given instruction becomes the input."""
    return df.select(
        *[c for c in df.columns if c not in ("instruction", "input", "output")],
        F.lit(K.CODE_SOLUTION_TEXT).alias("instruction"),
        F.col("instruction").alias("input"),
        "output",
    )


def code_syntax_rows(df: DataFrame) -> DataFrame:
    """(instruction, input, output): instruction and input are joined by a newline."""
    part = [F.coalesce(F.col(c), F.lit("")) for c in ("instruction", "input")]
    return df.select(
        *[c for c in df.columns if c not in ("instruction", "input", "output")],
        F.lit(K.CODE_PROMPT_TEXT).alias("instruction"),
        X.strip_ws(F.concat_ws("\n", *part)).alias("input"),
        "output",
    )


def word_problem_rows(df: DataFrame) -> DataFrame:
    """(question, answer)."""
    return df.select(
        *[c for c in df.columns if c not in ("question", "answer")],
        F.lit(K.WORD_PROBLEM_TEXT).alias("instruction"),
        F.col("question").alias("input"),
        F.col("answer").alias("output"),
    )


def render_chatml(df: DataFrame) -> DataFrame:
    return df.withColumn("text", prompts.chatml("instruction", "input", "output"))


def tool_call_audit(df: DataFrame, text: str) -> DataFrame:
    """The code of the tool call in each text and whether it imports a blocked module."""
    code = df.withColumn("code", X.extract_tool_call(text))
    return code.withColumn("blocked", F.coalesce(X.imports_blocked("code"), F.lit(False)))
