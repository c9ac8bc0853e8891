"""Shuffles, exact samples, caps, splits, balancing and mixing; all seeded and repeatable."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom.functions import draws
from threadloom.operators.ranks import hash_rank, position_rank
from threadloom.session import materialise

SEED = "42"


def seeded_shuffle(df: DataFrame, key: str, seed: str = SEED) -> DataFrame:
    """A random order as a rank column. Sort by it, or write the buckets in its order."""
    return hash_rank(df, key, seed, name="rank")


def sample_exact(df: DataFrame, key: str, n: int = K.FORUM_SAMPLE, seed: str = SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows when there are fewer)."""
    return hash_rank(df, key, seed, at_most=n)


def first_rows(df: DataFrame, position: str, n: int) -> DataFrame:
    """The first ``n`` rows by position: a cap after filtering."""
    return position_rank(df, position, n)


def cap_per_source(
    df: DataFrame, source: str, key: str, cap: int = K.SOURCE_CAP, seed: str = SEED
) -> DataFrame:
    """At most ``cap`` random rows per source."""
    return hash_rank(df, key, seed, by=(source,), at_most=cap)


def train_test_split(df: DataFrame, key: str, test_percent: int, seed: str = SEED) -> DataFrame:
    """Label each row ``train`` or ``test`` by its key; needs no shuffle."""
    is_test = draws.pick(f"{seed}-split", 100, key) < test_percent
    return df.withColumn("part", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def balance_classes(
    df: DataFrame, label: str, key: str, target: int = K.BALANCED_CLASS_SIZE, seed: str = SEED
) -> DataFrame:
    """Exactly ``target`` rows per class: a sample, or draws with replacement. Rows without a
    label belong to no class and are left out.

    A class with enough rows takes its first ``target`` rows by rank. A smaller class makes
    ``target`` draws; draw ``i`` hits the row with rank ``hash(class, i) mod size``. The
    draws are generated in two steps so that no single row expands to a whole class.
    """
    df = df.where(F.col(label).isNotNull())
    sizes = materialise(df.groupBy(label).agg(F.count("*").alias("_size")))
    step = 4096
    small = sizes.where(F.col("_size") < target)
    draws_of = (
        small.select(
            label, "_size", F.explode(F.sequence(F.lit(0), F.lit((target - 1) // step))).alias("_block")
        )
        .repartition(label, "_block")
        .select(label, "_size", F.explode(F.sequence(F.lit(0), F.lit(step - 1))).alias("_i"), "_block")
        .select(label, "_size", (F.col("_block").cast("bigint") * step + F.col("_i")).alias("draw"))
        .where(F.col("draw") < target)
        .withColumn("rank", draws.draw(f"{seed}-up", label, "draw") % F.col("_size") + 1)
        .drop("_size")
    )
    ranked = hash_rank(df, key, seed, by=(label,), at_most=target).join(sizes, label)
    kept = ranked.where(F.col("_size") >= target).withColumn("draw", F.col("rank") - 1)
    drawn = ranked.where(F.col("_size") < target).join(draws_of, [label, "rank"])
    return kept.unionByName(drawn).drop("rank", "_size")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def merge_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Union by name of tables with different columns, tagged with their source."""
    tagged = [df.withColumn("origin", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def mix_report(df: DataFrame, source: str) -> DataFrame:
    """Rows and share per source."""
    counts = df.groupBy(source).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(source, "rows", F.round(F.col("rows") / total, 6).alias("share"))


def mixture_sample(
    df: DataFrame, source: str, key: str, quotas: dict[str, int], seed: str = SEED
) -> DataFrame:
    """Up to the quota of random rows from each named source; other sources give none."""
    quota: Column = F.lit(None).cast("bigint")
    for name, rows in quotas.items():
        quota = F.when(F.col(source) == name, F.lit(rows)).otherwise(quota)
    named = df.where(F.col(source).isin(*quotas))
    return hash_rank(named, key, seed, by=(source,), at_most=quota)


def apportion(total: int, shares: dict[str, int]) -> dict[str, int]:
    """Whole numbers in proportion to ``shares`` that add up to ``total``: each gets its share
    rounded down, and the largest remainders (of equal ones the first named) one more."""
    whole = sum(shares.values())
    if whole <= 0:
        return dict.fromkeys(shares, 0)
    parts = {name: total * share // whole for name, share in shares.items()}
    by_rest = sorted(shares, key=lambda name: -(total * shares[name] % whole))
    for name in by_rest[: total - sum(parts.values())]:
        parts[name] += 1
    return parts


def filled_quotas(total: int, shares: dict[str, int], rows: dict[str, int]) -> dict[str, int]:
    """Quotas by ``shares`` where no source gives more than it has: what a short source lacks
    is shared out among the others. They add up to ``total``, or to all rows if there are fewer."""
    taken: dict[str, int] = {}
    while True:
        open_shares = {name: share for name, share in shares.items() if name not in taken}
        quotas = apportion(total - sum(taken.values()), open_shares)
        short = {name: rows.get(name, 0) for name, n in quotas.items() if n >= rows.get(name, 0)}
        if not short:
            return {name: {**quotas, **taken}[name] for name in shares}
        taken |= short


def percent_quotas(total: int, shares=K.MIX_PERCENT) -> dict[str, int]:
    """The quotas of the published mix; they add up to ``total``."""
    return apportion(total, dict(shares))


def exact_mixture(
    df: DataFrame, source: str, key: str, total: int, shares: dict[str, int], seed: str = SEED
) -> DataFrame:
    """A mixture of ``total`` random rows by shares, whatever single sources lack.

    Only the rows per named source are counted before the sample.
    """
    counts = df.where(F.col(source).isin(*shares)).groupBy(source).count().collect()  # a row per share
    return mixture_sample(df, source, key, filled_quotas(total, shares, dict(map(tuple, counts))), seed)
