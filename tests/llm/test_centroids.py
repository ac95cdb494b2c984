from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contractflow.llm import centroids
from contractflow.llm.centroids import History, cluster, described, opening, squared, step

TABLE = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds, dims, scale=256, seed=2):
    kept = [(i, [math.floor(scale * float(np.float32(v))) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        where = [nearest(x)[1] for _, x in kept]
        for j in range(len(c)):
            own = [x for (_, x), w in zip(kept, where, strict=True) if w == j]
            if own:
                c[j] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    return [(i, *nearest(x)[::-1]) for i, x in kept], c


def check(spark, rows, k, rounds, dims, scale=256):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], TABLE).repartition(3)
    got, found = cluster(df.withColumns({"cluster": F.lit("theirs"), "x": F.lit(1), "held": F.lit(2)}), k=k, rounds=rounds, dims=dims, scale=scale)
    expected, c = plain(rows, k, rounds, dims, scale)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert [f["centroid"] for f in found] == c
    for f in found:
        own = [r for r in expected if r[1] == f["cluster"]]
        assert (f["vectors"], f["inertia"]) == (len(own), sum(r[2] for r in own))
    return got, found


@pytest.mark.parametrize("k, rounds, dims, scale", [(3, 3, 2, 4), (12, 5, 3, 2), (7, 0, 2, 1), (17, 4, 8, 256)])
def test_against_plain_rounds(spark, k, rounds, dims, scale):
    """Coarse grids make many ties and empty clusters."""
    rng = np.random.default_rng(k)
    rows = [(i, rng.normal(0, 1, dims).astype(np.float32).tolist()) for i in range(200)]
    check(spark, rows + rows[:20] + [(900 + i, rows[0][1]) for i in range(30)], k, rounds, dims, scale)


def test_odd_rows(spark):
    bad = [None, [], [1.0], [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [1.0, 2.0, 3.0]]
    rows = [(i, e) for i, e in enumerate(bad)] + [(None, [0.5, 0.5]), (20, [0.25, -0.1]), (20, [0.25, -0.1]), (21, [1000.0, -1000.0])]
    _, found = check(spark, rows, 40, 5, 2)
    assert len(found) == 4
    got, found = cluster(spark.createDataFrame([], TABLE), dims=2)
    assert got.count() == 0 and found == [] and described(spark, found).count() == 0
    with pytest.raises(Exception, match="would not fit"):
        cluster(spark.createDataFrame([(1, [1e6, 0.0], 0)], TABLE), dims=2)[0].count()


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-centroids.LARGEST, centroids.LARGEST, (20, 64)), rng.integers(-centroids.LARGEST, centroids.LARGEST, (5, 64))
    assert squared(x, c).tolist() == [[sum((a - b) ** 2 for a, b in zip(p, q, strict=True)) for q in c.tolist()] for p in x.tolist()]


def test_bounds_spare_work_and_loosen_by_total_displacement():
    """Centroids that wander and come back: the total displacement is nothing, the sum of drifts is large."""
    rng = np.random.default_rng(2)
    c = rng.integers(-10_000, 10_000, (20, 16))
    x = (c[rng.integers(0, 20, 2000)] + rng.integers(-300, 300, (2000, 16))).astype(np.int64)
    first = History([c])
    state = opening(x, first)
    state, cost = step(x, state, History([c, c + 50]))
    assert cost == 0
    back, cost = step(x, state, History([c, c + 400, c]))
    assert cost == 0 and (back.cluster == state.cluster).all() and (back.far == state.far).all()
    moved = History([c, c[::-1]])
    after, cost = step(x, state, moved)
    assert cost > 0 and (after.cluster == squared(x, moved.now).argmin(1)).all()
