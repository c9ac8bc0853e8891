"""Hard negatives against brute force, on vectors with clusters, copies and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, block string, row string"


def brute(rows, share=80, n=5):
    """Rows (id, vector, label) to result tuples, by all products."""
    whole = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], y)
        for i, v, y in rows
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1])
    out = []
    for a, (i, v, y) in enumerate(whole):
        if i is None or i % 100:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, z == y) for b, (j, w, z) in enumerate(whole) if b != a]
        for ps, p, _ in sorted([s for s in scored if s[2]], key=order)[:n]:
            found = [s for s in scored if not s[2] and share * ps <= 100 * s[0] <= 100 * ps]
            out += [(i, p, k, j, ps, s) for k, (s, j, _) in enumerate(sorted(found, key=order)[:n], 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "own", "own") for i, v, y in rows], SCHEMA)


def mined(spark, rows, **shape):
    found = hn.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, shape=hn.Shape(**shape))
    assert found.columns == [f.split()[0] for f in hn.RESULT.split(", ")]
    return sorted(map(tuple, found.collect()), key=str)


def clusters(seed, n, dims=16, spread=0.05, groups=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, v.tolist(), int(rng.integers(0, labels))) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_brute_force(spark, spread):
    rows = clusters(1, 900, spread=spread)
    want = brute(rows)
    assert want and mined(spark, rows, codes=6, sample=200, block_rows=64, slice_rows=4) == want
    assert mined(spark, rows) == want


def test_copies_and_ties(spark):
    """A third of all rows are one vector, ids repeat, and a cell is far larger than a block."""
    rows = clusters(2, 600, spread=0.3)
    rows += [(1000 + i % 150, rows[0][1], i % 3) for i in range(300)]
    rows += [(400, rows[7][1], 1), (400, rows[7][1], 1)]
    assert mined(spark, rows, codes=4, block_rows=50) == brute(rows)


def test_odd_rows(spark):
    """Nulls anywhere, infinite and missing components, short and empty vectors, large numbers, negative scores."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, -1.0], 1), (1, [0.5, 2.0], 1), (2, [], 2), (3, None, 1), (4, [1.0, None], 1), (5, [nan], 1), (6, [inf, 1.0], 2)]
    rows += [(7, [1.0, 1.9, -1.0], None), (None, [1.0, 1.9, -1.0], 2), (None, [1.0, 1.9, -1.0], 1), (8, [1.0, 1.9, -1.0], 2)]
    rows += [(100, [-1.0, -2.0], 1), (200, [3e6, 1.0, 2e6], 3), (201, [2.9e6, 1.0, 2e6], 3), (202, [2.8e6, 1.0, 2e6], 4), (300, [1.0], 9)]
    assert mined(spark, rows) == brute(rows)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, None, 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchors


def test_multi_sequence_visits_all_pairs_in_order():
    rng = np.random.default_rng(3)
    one, two = rng.normal(size=7), rng.normal(size=5)
    visited = list(hn.multi_sequence(one, two))
    assert [b for b, _, _ in visited] == sorted((float(a + b) for a in one for b in two), reverse=True)
    assert {(i, j) for _, i, j in visited} == {(i, j) for i in range(7) for j in range(5)}
    assert all(b == one[i] + two[j] for b, i, j in visited)


def test_search_stops_when_the_window_is_certified():
    """Bounds hold for every row, and on clustered vectors most cells are never visited."""
    import pyarrow as pa

    rows = clusters(4, 2000, spread=0.02, groups=30)
    x = np.floor(256 * np.array([r[1] for r in rows], np.float64)).astype(np.int64)
    books = hn.Codebooks(16, 8, ())
    books.centres = tuple(hn.k_means(h, 12, 8) for h in books.halves(x.astype(float)))
    codes = [hn.nearest(h, c) for h, c in zip(books.halves(x.astype(float)), books.centres)]
    far = [np.sqrt(((h - c[k]) ** 2).sum(1)) for h, c, k in zip(books.halves(x.astype(float)), books.centres, codes)]
    radii = tuple(np.array([f[k == j].max(initial=0) for j in range(12)]) for f, k in zip(far, codes))
    cells = sorted(set(zip(codes[0].tolist(), codes[1].tolist())))
    c1, c2 = (np.array(c) for c in zip(*cells))
    plan = hn.Plan(books, radii, c1, c2, np.array([0]), np.array([0]), np.array([1]), 1)
    number = {c: k for k, c in enumerate(cells)}
    place = pa.StructArray.from_arrays([pa.array([0] * 2000), pa.array(range(2000))], ["file", "index"])
    columns = {
        "cell": pa.array([number[c] for c in zip(codes[0].tolist(), codes[1].tolist())]),
        "label": pa.array([r[2] for r in rows]), "id": pa.array(range(2000)), "row": place,
        "vec": pa.array([v.astype("<i8").tobytes() for v in x]),
    }
    block = hn.Block(pa.table(columns), plan)
    one, two = plan.bounds(x[:50].astype(float))
    assert (one[:, codes[0]] + two[:, codes[1]] >= x[:50] @ x.T).all()
    for k in range(50):
        found = block.positives(x[k], rows[k][2], (0, k), [], 5, (one[k], two[k]))
        scores = x @ x[k]
        best = sorted([(-int(scores[j]), j) for j in range(2000) if j != k and rows[j][2] == rows[k][2]])[:5]
        assert [(-s, int(block.id[at])) for _, s, at in found] == best
    assert block.visited < 0.3 * 50 * len(cells)
