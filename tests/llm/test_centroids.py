from __future__ import annotations

import hashlib

import numpy as np
import pytest

from areaflow.llm import centroids


def table(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "a", 2) for i, v in rows], "vec_id long, embedding array<double>, label int, v string, cluster int"
    )


def brute(rows, k, rounds, size, scale=256):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    middle = [list(v) for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            middle[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted(((i, *nearest(v)[::-1]) for i, v in kept), key=str), middle


def some_rows(n, size, spread):
    rng = np.random.default_rng(n)
    middles = rng.normal(size=(6, size))
    v = middles[rng.integers(0, 6, n)] + rng.normal(scale=spread, size=(n, size))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(n, None), (n + 1, []), (n + 2, [0.0] * (size - 1)), (n + 3, [None] * size), (n + 4, [float("nan")] * size)]
    odd += [(n + 5, [float("inf")] + [0.0] * (size - 1)), (n + 6, [0.0] * size), (None, rows[0][1]), (3, rows[5][1]), rows[7]]
    return rows + odd


@pytest.mark.parametrize(("n", "size", "k", "spread", "pivots"), [(200, 8, 7, 0.4, 16), (150, 3, 5, 0.01, 2), (60, 1, 4, 1.0, 3)])
def test_equals_all_distances(spark, n, size, k, spread, pivots):
    rows = some_rows(n, size, spread)
    assigned, final = centroids.cluster(table(spark, rows), k=k, rounds=3, size=size, pivots=pivots)
    expected, middle = brute(rows, k, 3, size)
    assert final.tolist() == middle
    found = assigned.collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=str) == expected
    described = centroids.with_inertia(assigned, final).collect()
    for r in described:
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in expected)


def test_equal_vectors_and_few_of_them(spark):
    rows = [(i, [0.5, -0.25]) for i in range(9)] + [(9, [0.5, 0.25])]
    assigned, final = centroids.cluster(table(spark, rows), k=40, size=2)
    expected, middle = brute(rows, 40, 5, 2)
    assert final.tolist() == middle
    assert sorted((r.vec_id, r.cluster, r.distance) for r in assigned.collect()) == sorted(expected)


def test_no_rows(spark):
    assigned, final = centroids.cluster(table(spark, []))
    assert assigned.count() == 0
    assert centroids.with_inertia(assigned, final).count() == 0


def test_components_too_large_for_exact_distances(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(table(spark, [(1, [1e30, 0.0])]), size=2)


def test_bounds_hold_and_leave_few_distances(spark):
    """Lower and upper bounds enclose every distance, and most centroids are not compared."""
    rng = np.random.default_rng(4)
    points = rng.integers(-500, 500, (6, 64))
    v = points[rng.integers(0, 6, 3000)] + rng.integers(-60, 60, (3000, 64))
    middle = v[:40]
    simplex = centroids.Simplex(middle, 12)
    own, other = (simplex.apexes(simplex.distances(x)) for x in (v, middle))
    exact = ((v[:, None, :] - middle[None]) ** 2).sum(-1) ** 0.5
    inner = ((own[:, None, :-1] - other[None, :, :-1]) ** 2).sum(-1)
    lower = (inner + (own[:, None, -1] - other[None, :, -1]) ** 2) ** 0.5
    upper = (inner + (own[:, None, -1] + other[None, :, -1]) ** 2) ** 0.5
    assert (lower <= exact + 1e-3).all()
    assert (upper >= exact - 1e-3).all()
    number, distance, compared = centroids.Nearest(simplex, middle)(v, own)
    assert (number == (exact**2).round().argmin(1)).all()
    assert (distance == (exact**2).round().min(1)).all()
    assert compared < 0.5 * exact.size
