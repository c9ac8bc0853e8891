import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from threadloom.llm import sharding
from threadloom.llm.queries import op5_sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 37, 100, 1000, 4097])
def test_permutation_is_one_and_can_be_undone(spark, n):
    rows = F.lit(n).cast("long")
    df = spark.range(n).select("id", sharding.permute(F.col("id"), rows, 7).alias("y"))
    df = df.select("id", "y", sharding.unpermute(F.col("y"), rows, 7).alias("x"))
    got = df.collect()
    assert sorted(r.y for r in got) == list(range(n))
    assert all(r.x == r.id for r in got)


def plain_position(x, n, seed):
    """The position of a row number, by a Feistel network in plain numbers that walks until it is inside."""
    import xxhash

    def chained(*values):
        at = 42
        for value, size in values:
            at = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), at)
        return at - (1 << 64) if at >= 1 << 63 else at

    left = math.isqrt(n - 1) + 1 if n > 1 else 1
    right = -(-n // left)
    while True:
        high, low = divmod(x, right)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                high = (high + chained((low, 8), (i, 4), (seed, 4)) % left) % left
            else:
                low = (low + chained((high, 8), (i, 4), (seed, 4)) % right) % right
        x = high * right + low
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1003])
def test_positions_equal_a_plain_network(spark, n):
    rows = F.lit(n).cast("long")
    got = spark.range(n).select("id", sharding.permute(F.col("id"), rows, 5).alias("y")).collect()
    assert {r.id: r.y for r in got} == {x: plain_position(x, n, 5) for x in range(n)}


def test_shards_and_slots_follow_from_row_numbers(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.shard(docs.select("doc_id", "text"), 8).collect()
    for r in got:
        at = plain_position(r.row_number, len(got), 0)
        assert (r["shard"], r.slot) == (at % 8, at // 8)


def test_shards_and_slots(spark, sf):
    got = op5_sharding(spark, sf).toPandas()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == n and sorted(got.doc_id) == list(range(n))
    counts = Counter(got["shard"])
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_same_result_however_the_rows_lie(spark, sf, shuffle_partitions):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source")
    a = sharding.shard(docs, 8, seed=3).collect()
    shuffle_partitions(7)
    b = sharding.shard(docs.repartition(5, "source"), 8, seed=3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sorted(map(tuple, a)) != sorted(map(tuple, sharding.shard(docs, 8, seed=4).collect()))


def test_shuffles(spark):
    got = sharding.shard(spark.range(2000), 4).toPandas().sort_values(["shard", "slot"])
    assert abs(got.id.iloc[:500].mean() - 1000) < 120
    assert abs(got.id.reset_index(drop=True).corr(got.index.to_series().reset_index(drop=True))) <= 1


def test_repeated_rows_are_numbered_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_COPIES", 16)
    df = spark.range(300).select((F.col("id") % 2 * F.col("id")).alias("k"))
    got = sharding.shard(df, 3, buckets=5).toPandas()
    assert sorted(got.row_number) == list(range(300)) and (got.k == 0).sum() == 150
    assert sorted(zip(got["shard"], got.slot, strict=True)) == [(s, i) for s in range(3) for i in range(100)]


def test_odd_rows(spark):
    got = sharding.shard(helpers.odd(spark), 4)
    assert got.columns.count("shard") == 1 and got.schema["shard"].dataType.simpleString() == "int"
    rows = got.collect()
    assert len(rows) == 10 and sorted(r["row_number"] for r in rows) == list(range(10))
    assert sharding.shard(helpers.empty(spark), 4).count() == 0


def test_only_expressions(spark, sf):
    text = op5_sharding(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
