import hashlib

import numpy as np
import pytest

from lagline.llm import simplex

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def slow(rows, size, scale=64, count=16, rounds=3):
    kept = [
        (i, [int(np.floor(scale * x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and abs(x) < np.inf for x in v)
    ]
    named = sorted((hashlib.sha256(b"1:%d" % i).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:count]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    ends = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in ends)
    return sorted(
        (
            (i, j, d, sum(e[1] for e in ends if e[2] == j), inertia,
             hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for i, d, j in ends
        ),
        key=str,
    )


def clustered(frame, size):
    found = simplex.cluster(frame, "id", "v", size)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=str)


def framed(spark, rows):
    schema = "id long, v array<double>, vec_id string, apex int, cluster string"
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], schema)


def test_same_as_comparing_everything(spark, monkeypatch):
    monkeypatch.setattr(simplex, "SLICE", 100)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(9, 12)) * 3
    rows = [(i, (centres[i % 9] + draw.normal(size=12)).tolist()) for i in range(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1300)] + rows[:50]  # copies, and repeated rows
    rows += [(i, np.round(draw.normal(size=12)).tolist()) for i in range(1300, 1400)]
    assert clustered(framed(spark, rows).repartition(6), 12) == slow(rows, 12)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, -1.0]), (3, None), (4, []), (5, [1.0, None]),
        (6, [nan, 1.0]), (7, [-inf, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [0.1, 0.1]), (9, [-0.01, 0.0]),
    ]
    assert clustered(framed(spark, rows), 2) == slow(rows, 2)
    assert clustered(framed(spark, rows).limit(0), 2) == []
    assert clustered(framed(spark, [(None, [1.0, 1.0])]), 2) == []
    same = [(i, [0.25, 0.5]) for i in range(40)]
    assert clustered(framed(spark, same), 2) == slow(same, 2)


def test_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="component is over"):
        clustered(framed(spark, [(1, [1e9, 1.0])]), 2)


@pytest.mark.parametrize("size", [2, 8, 64])
def test_bounds_hold(size):
    draw = np.random.default_rng(size)
    points = draw.integers(-500, 500, size=(300, size))
    centroids = draw.integers(-500, 500, size=(16, size))
    centroids[5] = centroids[4]
    pivots = simplex.pivots_of(centroids)
    assert len(pivots) == min(simplex.PIVOTS, size + 1)
    base = simplex.simplex(pivots)
    own = simplex.apexes(simplex.squares(points, pivots), base)
    others = simplex.apexes(simplex.squares(centroids, pivots), base)
    lower, upper = simplex.bounds(own, others)
    exact = simplex.squares(points, centroids)
    assert (lower <= exact).all() and (exact <= upper).all()
    best, distance = simplex.nearest(points, own, centroids, others)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
