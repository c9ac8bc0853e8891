"""The network's gradient, its distributed sums and its training."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from threadloom.operators import network as nw
from threadloom.session import new_stage

SIZES = (5, 4, 3, 3)


def some_rows(n=60, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) * (rng.random((n, 5)) < 0.6)
    return x, rng.integers(0, 3, n)


def frame(spark, x, y):
    """Every second row is a sparse vector."""
    rows = [
        (i, Vectors.dense(v) if i % 2 else Vectors.sparse(5, [(j, a) for j, a in enumerate(v.tolist()) if a]), int(c))
        for i, (v, c) in enumerate(zip(x, y))
    ]
    return spark.createDataFrame(rows, ["k", "f", "c"])


def loss(net, x, y, masks):
    layers = net.layers()
    for (w, b), m in zip(layers[:-1], masks):
        x = np.maximum(x @ w + b, 0) * m
    z = x @ layers[-1][0] + layers[-1][1]
    return float(sum(np.log(np.exp(r).sum()) - r[k] for r, k in zip(z, y)))


def test_gradient_equals_differences():
    x, y = some_rows(20)
    net = nw.initial(SIZES, 1)
    masks = nw.dropout_masks(np.arange(20), 3, nw.Settings(hidden=(4, 3), dropout=0.3))
    grad, lost = nw.gradient(net, x, y, masks)
    assert lost == pytest.approx(loss(net, x, y, masks))
    for i in range(len(net.flat)):
        up, down = net.flat.copy(), net.flat.copy()
        up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
        slope = (loss(nw.Network(SIZES, up), x, y, masks) - loss(nw.Network(SIZES, down), x, y, masks)) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-4)


@pytest.mark.parametrize("parts, lanes", [(1, 1), (7, 1), (7, 3)])
def test_sums_do_not_depend_on_partitions(spark, monkeypatch, parts, lanes):
    monkeypatch.setattr(nw, "SLICE", 16)
    x, y = some_rows()
    net, settings = nw.initial(SIZES, 2), nw.Settings(hidden=(4, 3))
    path = f"{new_stage(spark)}/w"
    nw.save(net, path)
    rows = frame(spark, x, y).select(F.xxhash64("k").alias("key"), *nw._sparse("f"), F.col("c").cast("int").alias("code"))
    keys = np.array([r.key for r in rows.collect()])
    grad, n, lost = nw.summed_gradients(rows.repartition(parts), path, 5, settings, lanes)
    want, loss = nw.gradient(net, x, y, nw.dropout_masks(keys, 5, settings))
    assert n == 60 and lost == pytest.approx(loss) and np.allclose(grad, want)


def test_training_equals_plain_training(spark):
    """The same steps in plain numpy, over the batches as they were dealt."""
    x, y = some_rows(90, 4)
    settings = nw.Settings(hidden=(4, 3), epochs=3, batch_rows=30, rate=0.05, task_rows=10)
    net, losses = nw.fit(frame(spark, x, y), "k", "f", "c", 5, 3, settings)
    table, steps = nw.batches(frame(spark, x, y), "k", "f", "c", settings)
    assert steps == 3 and len(losses) == 3
    parts = {}
    for r in frame(spark, x, y).select(F.xxhash64(F.lit(42), "k").alias("key"), "k").collect():
        parts.setdefault(r.key % steps, []).append((r.key, r.k))
    plain, adam = nw.initial((5, 4, 3, 3), 42), nw.Adam(len(net.flat), 0.05)
    for epoch in range(3):
        for b in np.random.default_rng([42, epoch]).permutation(steps).tolist():
            keys, at = np.array(parts[b]).T
            grad, _ = nw.gradient(plain, x[at], y[at], nw.dropout_masks(keys, adam.steps, settings))
            plain = nw.Network(plain.sizes, adam.move(plain.flat, grad / len(at)))
    assert np.allclose(plain.flat, net.flat)


def test_it_learns(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 300)
    x = np.eye(3)[y] + 0.1 * rng.normal(size=(300, 3))
    rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "k int, v array<double>, c int")
    rows = rows.withColumn("f", array_to_vector("v"))
    net, losses = nw.fit(rows, "k", "f", "c", 3, 3, nw.Settings(hidden=(16, 8), rate=0.02, epochs=12, batch_rows=64, dropout=0.2))
    assert losses[-1] < 0.5 * losses[0]
    path = f"{new_stage(spark)}/w"
    nw.save(net, path)
    scored = nw.score(spark, path, rows.drop("v"), "f", ["a", "b", "c"]).collect()
    assert np.mean([r.label == "abc"[r.c] for r in scored]) > 0.97
    assert all(1 / 3 <= r.confidence <= 1 for r in scored)


def wide_rows(n=300, width=500, seed=6):
    """Few entries in a row; some features in many rows, some in one."""
    rng = np.random.default_rng(seed)
    x = np.zeros((n, width))
    for row in x[1:]:  # the first row is empty
        row[np.unique((width * rng.random(8) ** 3).astype(int))] = rng.normal()
    return x


def test_sparse_products_equal_dense_ones():
    import pyarrow as pa

    x, rng = wide_rows(), np.random.default_rng(7)
    places = [np.flatnonzero(r).tolist() for r in x]
    lists = pa.array(places, pa.list_(pa.int32())), pa.array([r[p].tolist() for r, p in zip(x, places)], pa.list_(pa.float64()))
    ((at, found),) = nw.matrices(*lists, 500)
    assert isinstance(found, nw.Sparse) and at == slice(0, 300)
    held = (x != 0).sum(0)
    assert held.max() > nw._FEW > 1 == held[held > 0].min()
    w, d = rng.normal(size=(500, 7)), rng.normal(size=(300, 7))
    assert np.allclose(found @ w, x @ w) and np.allclose(found.T @ d, x.T @ d)


def test_masks_are_those_of_a_generator_per_key():
    keys, settings = np.array([0, 5, -(2**61), 2**62, -(2**62) - 12345]), nw.Settings(hidden=(4, 3))
    drawn = [np.random.Generator(np.random.Philox(key=[k, 9 << 32 | 42])).random(7) for k in keys.astype(np.uint64).tolist()]
    assert (np.hstack(nw.dropout_masks(keys, 9, settings)) == 2 * (np.array(drawn) >= 0.5)).all()


def fitted(spark, batch_rows=30, epochs=4, **more):
    x, y = some_rows(120, 8)
    return nw.fit(frame(spark, x, y), "k", "f", "c", 5, 3, nw.Settings(hidden=(4, 3), rate=0.05, epochs=epochs, batch_rows=batch_rows, **more))


def test_steps_are_not_jobs(spark):
    """40 steps of two tasks; each was a job."""
    spark.sparkContext.setJobGroup("steps", "")
    fitted(spark, epochs=10, task_rows=15)
    spark.sparkContext.setJobGroup("others", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("steps")) < 10


def test_no_files_of_steps_stay(spark):
    from pathlib import Path

    from threadloom.session import stage_folder

    folder = Path(stage_folder(spark).removeprefix("file:"))
    before = {p for p in folder.rglob("*") if p.is_file()}
    fitted(spark, task_rows=15)
    assert not {p for p in folder.rglob("*") if p.is_file()} - before


def test_tasks_and_stretches_do_not_change_a_model(spark, monkeypatch):
    net, losses = fitted(spark, task_rows=10)
    monkeypatch.setattr(nw, "STRETCH", 3)
    cut, again = fitted(spark, task_rows=10)
    assert (cut.flat == net.flat).all() and again == losses
    monkeypatch.setattr(nw, "_slots", lambda spark: 1)
    alone, again = fitted(spark, task_rows=10)
    assert (alone.flat == net.flat).all() and again == losses
    monkeypatch.setattr(nw, "GANG", 0)
    by_jobs, again = fitted(spark, task_rows=10)
    assert np.allclose(by_jobs.flat, net.flat) and np.allclose(again, losses)


def test_batches_without_rows_and_rows_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(nw, "_PIECE", 16)
    net, losses = fitted(spark, batch_rows=2, epochs=1, task_rows=1)
    assert np.isfinite(net.flat).all() and np.isfinite(losses).all()
    x, y = some_rows(90, 9)
    same = frame(spark, x, y).withColumn("k", F.lit(None).cast("long"))
    settings = nw.Settings(hidden=(4, 3), epochs=2, batch_rows=30, task_rows=10, dropout=0, rate=0.05)
    net, losses = nw.fit(same, "k", "f", "c", 5, 3, settings)
    plain, adam = nw.initial((5, 4, 3, 3), 42), nw.Adam(len(net.flat), 0.05)
    for _ in range(2):
        grad, _ = nw.gradient(plain, x, y, [np.ones((90, 4)), np.ones((90, 3))])
        plain = nw.Network(plain.sizes, adam.move(plain.flat, grad / 90))
    assert np.allclose(plain.flat, net.flat)


def test_wide_training_equals_plain_training(spark):
    x = wide_rows()
    y = np.random.default_rng(1).integers(0, 3, len(x))
    rows = [(i, Vectors.sparse(500, [(j, r[j]) for j in np.flatnonzero(r).tolist()]), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    settings = nw.Settings(hidden=(4, 3), epochs=3, batch_rows=300, task_rows=100, dropout=0, rate=0.05)
    net, losses = nw.fit(spark.createDataFrame(rows, ["k", "f", "c"]), "k", "f", "c", 500, 3, settings)
    plain, adam = nw.initial((500, 4, 3, 3), 42), nw.Adam(len(net.flat), 0.05)
    for loss in losses:
        grad, lost = nw.gradient(plain, x, y, [np.ones((300, 4)), np.ones((300, 3))])
        assert loss == pytest.approx(lost / 300)
        plain = nw.Network(plain.sizes, adam.move(plain.flat, grad / 300))
    assert np.allclose(plain.flat, net.flat)


@pytest.mark.parametrize("column", ["f", "c"])
def test_null_features_or_codes_are_an_error(spark, column):
    rows = frame(spark, *some_rows(20))
    rows = rows.withColumn(column, F.when(F.col("k") != 7, F.col(column)))
    with pytest.raises(Exception, match="null features or codes"):
        nw.fit(rows, "k", "f", "c", 5, 3, nw.Settings(hidden=(4, 3), epochs=1, batch_rows=30))


def test_stems_stay_in_their_rows(spark):
    """No exchange is needed to stem the words of a table."""
    from threadloom.operators import features, router

    df = spark.range(1000).select("id", F.array(F.lit("running"), F.concat(F.lit("cats"), "id")).alias("w"))
    plan = features.stemmed(df, "w")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan
    prepared = router.prepare(df.select("id", F.array_join("w", " ").alias("text")), "text")
    assert "Exchange" not in prepared._jdf.queryExecution().executedPlan().toString()
