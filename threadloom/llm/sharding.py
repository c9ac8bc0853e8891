"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 .. N-1 in the order of a hash of the whole row, so the numbers do not
depend on files, partitions or executors. A keyed Feistel permutation sends row number x to
position y; the shard is y mod shards and the slot y div shards, both computable from x (and
x from them) without any table. Shards differ by one row at most and slots have no gaps.

Nulls are values like any other; repeated rows are numbered one after the other; an empty
table gives an empty result; added columns replace columns of the same name.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

ROUNDS = 8
#: Steps of cycle walking. Fewer than sqrt(N) + 1 positions lie outside the table, so small
#: tables never walk longer, and for others one step fails with probability 1 / sqrt(N): a
#: longer walk, which would raise an error, has a probability below 10**-30.
WALK = 24
#: Buckets of the numbering; each is sorted on its own, so rows / BUCKETS must fit a task
#: (with spilling). Only this many sizes are summed up in one place.
BUCKETS = 4096
_COPIES = 1 << 16


def _round(x: Column, i: Column, left: Column, right: Column, seed: int, sign: int) -> Column:
    """One round on x = l * right + r: even rounds move l by a hash of r, odd ones r by one of l."""
    high, low = F.call_function("div", x, right), x % right
    key = F.when(i % 2 == 0, low).otherwise(high)
    size = F.when(i % 2 == 0, left).otherwise(right)
    shift = F.lit(sign) * F.pmod(F.xxhash64(key, i, F.lit(seed)), size)
    moved = F.pmod(F.when(i % 2 == 0, high).otherwise(low) + shift, size)
    return F.when(i % 2 == 0, moved * right + low).otherwise(high * right + moved)


def _permute(x: Column, rows: Column, left: Column, right: Column, seed: int, back: bool) -> Column:
    order = list(range(ROUNDS))[:: -1 if back else 1]
    rounds = F.array(*[F.lit(i) for i in order])

    def once(y: Column) -> Column:
        return F.aggregate(
            rounds, y, lambda acc, i: _round(acc, i, left, right, seed, -1 if back else 1)
        )

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        once(x),
        lambda acc, _: F.when(acc < rows, acc).otherwise(once(acc)),
    )
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk too long")))


def _halves(rows: Column) -> tuple[Column, Column]:
    """The two radices: left * right >= rows, and less than ``left`` positions too many."""
    left = F.ceil(F.sqrt(rows.cast("double"))).cast("long")
    return left, F.call_function("div", rows + left - 1, left)


def permute(number: Column, rows: Column, seed: int = 0) -> Column:
    """The position of a row number under the permutation of 0 .. rows-1."""
    return _permute(number.cast("long"), rows, *_halves(rows), seed, False)


def unpermute(position: Column, rows: Column, seed: int = 0) -> Column:
    """The row number at a position."""
    return _permute(position.cast("long"), rows, *_halves(rows), seed, True)


def numbered(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc`` (the row), ``number`` (0 .. N-1) and ``rows`` (N), by a hash of the whole row.

    Equal rows are counted before the shuffle, so a row repeated any number of times is one
    row of the sort; its copies are dealt out in runs afterwards.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    hashed = df.select(whole.alias("doc"), F.xxhash64(whole).alias("hash"))
    counted = materialise(hashed.groupBy("hash", "doc").agg(F.count("*").alias("copies")))
    bucket = F.pmod("hash", F.lit(buckets)).alias("bucket")
    sizes = counted.groupBy(bucket).agg(F.sum("copies").alias("size"))
    whole_table = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # at most ``buckets`` rows
        "bucket",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(whole_table).alias("rows"),
    )
    inside = (
        Window.partitionBy("bucket").orderBy("hash", "doc").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("before") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    ranked = (
        counted.select("*", bucket)
        .join(F.broadcast(offsets), "bucket")
        .select("doc", "rows", "copies", first.alias("first"))
    )
    starts = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(_COPIES).cast("long")))
    many = F.col("copies") > _COPIES
    runs = ranked.where(~many).select("*", F.lit(0).cast("long").alias("run")).unionByName(
        ranked.where(many).select("*", starts.alias("run")).repartition("first", "run")
    )
    last = F.least(F.col("run") + _COPIES, F.col("copies")) - 1
    copies = runs.select("*", F.explode(F.sequence("run", last)).alias("copy"))
    return copies.select("doc", (F.col("first") + F.col("copy")).alias("number"), "rows")


def shard(df: DataFrame, shards: int, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``df`` with ``row_number``, ``shard`` and ``slot``."""
    added = ("row_number", "shard", "slot")
    placed = numbered(df, buckets).select("doc", "number", permute(F.col("number"), F.col("rows"), seed).alias("at"))
    kept = [F.col(f"doc.`{c}`").alias(c) for c in df.columns if c not in added]
    return placed.select(
        *kept,
        F.col("number").alias("row_number"),
        (F.col("at") % shards).cast("int").alias("shard"),
        F.call_function("div", F.col("at"), F.lit(shards)).cast("long").alias("slot"),
    )
