"""Ranks and running totals that never put one whole group into one task."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import draws


def _cell(by: tuple[str, ...], part: Column) -> Column:
    """Group and bucket as one struct: joins on it also match groups whose key is null."""
    return F.struct(*[F.col(c).alias(f"by_{c}") for c in by], part.alias("part"))


def _earlier(by: tuple[str, ...]):
    groups = [F.col(f"_cell.by_{c}") for c in by] or [F.lit(0)]
    order = Window.partitionBy(*groups).orderBy("_cell.part")
    return order.rowsBetween(Window.unboundedPreceding, -1)


def _offsets(df: DataFrame, cell: Column, by: tuple[str, ...]) -> DataFrame:
    """Rows per cell, and the number of rows of the same group in the cells before it."""
    sizes = df.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(_earlier(by)), F.lit(0))
    return sizes.select("_cell", before.alias("_before"))


def hash_rank(
    df: DataFrame,
    key: str,
    seed: str,
    by: tuple[str, ...] = (),
    at_most: int | Column | None = None,
    digits: int = 3,
    name: str = "rank",
) -> DataFrame:
    """Rank rows by a seeded hash of a unique key, within ``by`` or over the whole table.

    The hash is uniform, so its first ``digits`` hex digits cut even the hottest group into
    ``16**digits`` even buckets. Only bucket sizes are summed up centrally; rows are sorted
    bucket by bucket. With ``at_most`` (a number, or a column over ``by``) the buckets past
    the limit are dropped before the shuffle, so a sample of n rows moves about n rows.
    ``df`` is read twice, the first time for the key only. ``digits`` is 4 at most, so the
    bucket sizes of a whole table (the only thing broadcast) stay within 65,536 rows.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    cell = _cell(by, F.substring(draws.digest(seed, key), 1, digits))
    offsets = _offsets(df, cell, by)
    if at_most is not None:
        limits = [F.col(f"_cell.by_{c}").alias(c) for c in by]
        limit = at_most if isinstance(at_most, Column) else F.lit(at_most)
        offsets = (
            offsets.select("_cell", "_before", *limits)
            .where(F.col("_before") < limit)
            .select("_cell", "_before")
        )
    if not by:  # at most 16**digits rows
        offsets = F.broadcast(offsets)
    order = Window.partitionBy("_cell").orderBy("_digest", key)
    ranked = (
        df.withColumns({"_digest": draws.digest(seed, key), "_cell": cell})
        .join(offsets, "_cell")
        .withColumn(name, F.col("_before") + F.row_number().over(order))
    )
    if at_most is not None:
        ranked = ranked.where(F.col(name) <= limit)
    return ranked.select(*df.columns, name)


def even_cells(df: DataFrame, position: str, cells: int, name: str) -> DataFrame:
    """Add a number that cuts the rows by position into ``cells`` ranges of about equal size.

    The cuts are quantiles of the data (a sketch of bounded size), so positions with large
    gaps, such as timestamps, are cut as evenly as dense ones. Equal positions share a cell.
    """
    # doubles keep the order of integers, and only equal cells must agree
    at = df.withColumn("_at", F.col(position).cast("double"))
    marks = at.approxQuantile("_at", [k / cells for k in range(1, cells)], 0.5 / cells)
    splits = [float("-inf"), *sorted(set(marks)), float("inf")]
    if len(splits) == 2:
        return df.withColumn(name, F.lit(0.0))
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol=name, handleInvalid="keep")
    return cut.transform(at).drop("_at")


def position_rank(
    df: DataFrame, position: str, at_most: int, cells: int = 1024, name: str = "rank"
) -> DataFrame:
    """The first ``at_most`` rows by a unique integer position, with their rank.

    Whole cells past the limit are dropped before the sort; only the ``cells`` sizes are
    summed up in one place.
    """
    part = even_cells(df, position, cells, "_part").withColumn("_cell", _cell((), F.col("_part")))
    offsets = _offsets(part, F.col("_cell"), ()).where(F.col("_before") < at_most)
    order = Window.partitionBy("_cell").orderBy(position)
    return (
        part.join(offsets, "_cell")
        .withColumn(name, F.col("_before") + F.row_number().over(order))
        .where(F.col(name) <= at_most)
        .select(*df.columns, name)
    )


def running_totals(
    df: DataFrame, by: tuple[str, ...], position: str, totals: dict[str, Column], cells: int = 1024
) -> DataFrame:
    """Running sums per group in the order of an integer position, unique within the group.

    Rows are cut into cells by position, so no task sorts a whole large group; the sums of
    earlier cells, at most ``cells`` per group, are added to those inside a cell.
    """
    parted = even_cells(df, position, cells, "_part")
    chunked = parted.withColumn("_cell", _cell(by, F.col("_part"))).drop("_part")
    sums = chunked.groupBy("_cell").agg(*[F.sum(e).alias(f"_sum_{n}") for n, e in totals.items()])
    before = _earlier(by)
    base = sums.select(
        "_cell",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in totals],
    )
    inside = (
        Window.partitionBy("_cell")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return chunked.join(base, "_cell").select(
        *df.columns,
        *[(F.col(f"_base_{n}") + F.sum(e).over(inside)).alias(n) for n, e in totals.items()],
    )
