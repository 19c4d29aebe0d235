import math

import numpy as np
import pytest

from quarry.llm import voronoi_knn as V

SCHEMA = "vec_id long, embedding array<float>, row int, score string"


def brute(rows, every=50, k=5):
    """The k best of all other rows, by whole numbers."""
    usable = []
    for n, (i, e, *_) in enumerate(rows):
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            usable.append((n, i, [math.floor(256 * np.float32(x).astype(float)) for x in e]))
    out = []
    for n, i, e in usable:
        if i is None or i % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(e, f)), j is None, j or 0, j) for m, j, f in usable if m != n)[:k]
        out += [(i, r, j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for r, (s, _, _, j) in enumerate(found, 1)]
    return sorted(out, key=repr)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in V.knn_join(df, **kw).collect()), key=repr)


def clusters(rnd, n, width=6, centres=8):
    at = rnd.normal(size=(centres, width)) * 5
    return [(i, [float(np.float32(x)) for x in at[i % centres] + rnd.normal(size=width) * 0.05]) for i in range(n)]


@pytest.mark.parametrize("pivots,block", [(1, 1), (16, 1), (16, 16 << 20)])
def test_against_brute_force(spark, pivots, block):
    rows = clusters(np.random.default_rng(3), 600)
    assert got(spark, rows, pivots=pivots, block_bytes=block, every=10) == brute(rows, 10)


def test_cells_spare_vectors(spark):
    """Far clusters go to no group they cannot matter to."""
    rows = clusters(np.random.default_rng(5), 800)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    held = V.prepared(df, "vec_id", "embedding", 1)
    longest = max(math.sqrt(sum(math.floor(256 * x) ** 2 for x in e)) for _, e in rows)
    space = V.choose_pivots(held, 6, longest, 32)
    count, near = V.cell_summaries(held, space, 6, 6)
    asking, low, high = V.query_bounds(held, space, 6, 6, near)
    assert count.sum() == 800 == asking.sum() and all(len(near[j]) == min(6, count[j]) for j in range(32))
    held_cells = np.flatnonzero(count)
    needed = (low[np.ix_(np.flatnonzero(asking), held_cells)] <= high[np.ix_(np.flatnonzero(asking), held_cells)])
    group, parts = V.pack_cells(asking, space, 60)
    assert len(parts) > 4 and needed.any(1).all()
    # and a row's own distance leaves most out
    sent = 0
    x = V.matrix(held.select("v").toArrow().column("v"), 6)
    d = space.distances(x, False)
    cell, least = d.argmin(1), d.min(1)
    for g in range(len(parts)):
        cells = np.flatnonzero(group == g)
        sent += int(((low[cells][:, cell] <= least) & (least <= high[cells][:, cell])).any(0).sum())
    assert sent < 0.6 * len(rows) * len(parts)


def test_odd_rows(spark):
    rnd = np.random.default_rng(1)
    rows = clusters(rnd, 120)
    rows += [(50, [1.0] * 6), (50, [1.0] * 6), (100, rows[7][1]), (None, rows[3][1]), (None, [9.0] * 6), (200, None), (250, [1.0, None]), (300, [float("nan")] * 6),
             (350, [float("inf")] * 6), (400, []), (450, [2.0]), (451, [0.5] * 9), (500, [0.0] * 6), (-50, [-0.0] * 6)]
    rows += [(1000 + i, [3.0] * 6) for i in range(300)]      # a vector that a great part of the rows share
    assert got(spark, rows, pivots=8, block_bytes=2048) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0])]) == [] == got(spark, [(50, [1.0])])
    assert got(spark, [(50, [1.0]), (51, [-2.0])]) == [(50, 1, 51, -131072)]


def test_scores_that_doubles_round(spark):
    rows = [(50, [1e8, 1.0, 3e6]), (1, [1e8, 0.25, 0.0]), (2, [1e8, 0.5, 0.0]), (3, [3e38, 1.0, 1.0]), (4, [-3e38, 0.0, 0.0]), (5, [1.0, 1.0, 1.0]), (6, [1e8, 0.25, 0.0])]
    assert got(spark, rows) == brute(rows)


def test_query(spark):
    from quarry.llm.queries import QUERIES
    df = QUERIES["op13_voronoi_knn"](spark, "/root/testdata/sf0.001")
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.count() == 50
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == brute(rows)
