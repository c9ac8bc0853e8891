"""Counts and profiles of tables and of raw JSON fields."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.schemas import CORRUPT
from threadloom.sources.readers import read_lines


def top_groups(df: DataFrame, column: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent values with their rank; ties by name.

    The rank window has no partition key, but it sees at most ``n`` rows.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    top = counts.orderBy(F.desc("rows"), column).limit(n)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("rows"), column)
    return top.withColumn("rank", F.row_number().over(order))


def discover_fields(df: DataFrame, json: str, position: str) -> DataFrame:
    """Every top-level JSON field with the place where it is first seen.

    Order by ``(first_line, first_place)`` gives the first-seen order.
    """
    keys = df.select(position, F.posexplode(F.json_object_keys(json)).alias("place", "field"))
    first = F.min(F.struct(position, "place"))
    return (
        keys.groupBy("field")
        .agg(first.alias("first"), F.count("*").alias("rows"))
        .select("field", F.col(f"first.{position}").alias("first_line"), "first.place", "rows")
        .withColumnRenamed("place", "first_place")
    )


def scan_header(
    spark: SparkSession, path: str, n: int = K.HEADER_SCAN_LINES
) -> DataFrame:
    """The fields in the first ``n`` lines of an NDJSON file."""
    head = read_lines(spark, path, "position").orderBy("position").limit(n)
    return discover_fields(head, "value", "position")


def dump_counts(rows: DataFrame) -> DataFrame:
    """Lines of a dump that were read, that could be parsed, and that could not."""
    return rows.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col(CORRUPT).isNull()).alias("good"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected"),
    )


def field_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Field counts of both sides and the number of common names."""
    a, b = left.select("field").distinct(), right.select("field").distinct()
    sides = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "field", "full")
    return sides.agg(
        F.count("l").alias("left_fields"),
        F.count("r").alias("right_fields"),
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("common"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def frame_profile(df: DataFrame) -> DataFrame:
    """Rows, non-null values and type per column, from one aggregation pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(dtype).alias("data_type"),
                F.col("_rows").alias("rows"),
                F.col(name).alias("non_null"),
            )
            for name, dtype in df.dtypes
        ]
    )
    return counts.select(F.inline(entries))
