"""Readers for newline-delimited JSON, plain or compressed."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import constants as K
from threadloom import schemas
from threadloom.functions import text as X
from threadloom.session import materialise
from threadloom.sources import dumps

TEXT_CANDIDATES = ("input", "question", "body")


def read_lines(spark: SparkSession, paths, position: str | None = None, split_bytes: int | None = None) -> DataFrame:
    """The lines of text files (also ``.zst``, ``.gz``) that are not blank, as ``value``.

    A line of white space only (as Python's ``strip`` takes it) is blank. ``position`` names
    a column with the order of the lines: the file by its path, the block in the file, the
    line in the block. Spark deals files out by size, so the order of the rows alone would
    not be that of the files. With ``split_bytes`` compressed files are read in splits of
    that size, see ``sources.dumps``.
    """
    if split_bytes:
        lines = dumps.read_splits(spark, paths, split_bytes)
        order = F.struct("file", "block", "line")
    else:
        lines = spark.read.text(paths)
        block = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        order = F.struct(*block, F.monotonically_increasing_id().alias("line"))
    lines = lines.select("value", *([order.alias(position)] if position else []))
    return lines.where(X.strip_ws("value") != "")


def read_dump(
    spark: SparkSession, paths, schema: T.StructType, position: str | None = None, split_bytes: int | None = None
) -> DataFrame:
    """Read NDJSON files with an explicit schema.

    The result has the extra column ``_corrupt_record``; see ``good_rows`` and
    ``rejected_rows``. ``position`` names a column with the order of the scan, for "the last
    row per id wins". Without ``split_bytes`` a compressed file is one task, so spread the
    rows after admission, and zstd frames may have a window of 2**27 at most; with it the frames
    of a file are dealt out in splits and windows reach 2**31.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    row = F.from_json("value", schemas.with_corrupt(schema), options)
    parsed = read_lines(spark, paths, position, split_bytes).withColumn("_row", row)
    corrupt = F.when(F.col("_row").isNull(), F.col("value")).otherwise(F.col(f"_row.{schemas.CORRUPT}"))
    return parsed.select(
        *[F.col(f"_row.{f.name}") for f in schema],
        corrupt.alias(schemas.CORRUPT),
        *([position] if position else []),
    )


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(schemas.CORRUPT).isNotNull())


def parse_lines(df: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column that was read elsewhere; adds ``parsed`` and ``is_valid``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = F.from_json(json, schemas.with_corrupt(schema), options)
    rows = df.withColumn("_row", parsed)
    valid = F.col("_row").isNotNull() & F.col(f"_row.{schemas.CORRUPT}").isNull()
    fields = F.struct(*[F.col(f"_row.{f.name}") for f in schema])
    return rows.withColumns({"parsed": fields, "is_valid": valid}).drop("_row")


def read_instruction_tables(spark: SparkSession, pattern: str, output_name: str) -> DataFrame:
    """Read every table that matches ``dir/*.jsonl`` except the merged output itself.

    Tables and output may be files or folders of part files. Adds the name of the table each
    row came from as ``origin``.
    """
    names = F.split(F.col("_position.file"), "/")
    last = F.element_at(names, -1)
    table = F.when(last.endswith(".jsonl"), last).otherwise(F.element_at(names, -2))
    rows = read_dump(spark, pattern, schemas.INSTRUCTION_ROWS, "_position").withColumn("origin", table)
    return good_rows(rows.where(F.col("origin") != output_name)).drop("_position")


def labelled_text(
    tables: dict[str, list[DataFrame]], candidates=TEXT_CANDIDATES
) -> DataFrame:
    """(text, category): the first candidate column each table has; others are skipped."""
    parts = []
    for category, frames in tables.items():
        for df in frames:
            column = next((c for c in candidates if c in df.columns), None)
            if column is not None:
                parts.append(df.select(F.col(column).alias("text"), F.lit(category).alias("category")))
    return reduce(DataFrame.unionByName, parts)


def read_labelled_text(
    spark: SparkSession,
    paths: dict[str, list[str]],
    candidates=TEXT_CANDIDATES,
    skip_missing: bool = False,
) -> DataFrame:
    """``labelled_text`` over JSONL paths, which may be patterns.

    A path that matches nothing is an error, or left out with ``skip_missing``. The columns of
    a table are those of all its good lines; a pattern may match tables with different ones.
    """
    tables: dict[str, list[DataFrame]] = {}
    for category, found in paths.items():
        for path in found:
            if path_exists(spark, path):
                tables.setdefault(category, []).append(_text_table(spark, path, candidates))
            elif not skip_missing:
                raise FileNotFoundError(path)
    return labelled_text(tables, candidates)


def _text_table(spark: SparkSession, path: str, candidates) -> DataFrame:
    """The texts of the tables of a path, under the name of the first candidate.

    A table is a file, or a folder of part files. Its text is the first candidate that any of
    its good lines has; tables without one are left out.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in candidates])
    lines = parse_lines(read_lines(spark, path, "_position"), "value", schema).where("is_valid")
    file = F.col("_position.file")
    part = F.element_at(F.split(file, "/"), -1).startswith("part-")
    keys = F.json_object_keys("value")
    rows = lines.select(
        F.when(part, F.regexp_replace(file, "/[^/]*$", "")).otherwise(file).alias("table"),
        F.coalesce(*[F.when(F.array_contains(keys, c), F.lit(i)) for i, c in enumerate(candidates, 1)]).alias("place"),
        F.array(*[F.col(f"parsed.`{c}`") for c in candidates]).alias("texts"),
    )
    chosen = materialise(rows.groupBy("table").agg(F.min("place").alias("chosen")).where("chosen is not null"))
    text = F.element_at("texts", F.col("chosen")).alias(candidates[0])
    return rows.select("table", "texts").join(chosen, "table").select(text)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a pattern matches anything."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def head_lines(spark: SparkSession, path: str, n: int = K.HEAD_SAMPLE_LINES) -> DataFrame:
    """The first raw lines of one file."""
    return spark.read.text(path).limit(n)


def head_rows(df: DataFrame, position: str, n: int = K.HEAD_SAMPLE_LINES) -> DataFrame:
    """The first rows of a table by position."""
    return df.orderBy(position).limit(n)
