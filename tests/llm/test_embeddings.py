from __future__ import annotations

import numpy as np
import pytest

from areaflow.llm import embedding_dedup
from tests.llm import docs

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, size int, d int"


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label, groups, spread in ((0, 12, 0.02), (1, 3, 0.03), (None, 2, 0.01)):
        for _ in range(groups):
            centre = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 25))):
                own = centre + rng.normal(size=16) * spread * np.linalg.norm(centre)
                rows.append((n, (own * rng.uniform(0.1, 9)).astype(np.float32).tolist(), label))
                n += 1
        rows += [(n + k, rows[-1][1], label) for k in range(40)]  # equal vectors
        n += 40
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [3e38] * 16]
    rows += [(n + k, e, 0) for k, e in enumerate(odd)]
    return rows


def expected(rows):
    def usable(e):
        return e and all(v is not None and np.isfinite(v) for v in e) and any(e)

    links = []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a, float), np.array(b, float)
            if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                links.append((i, j))
    low = docs.smallest(list(range(len(rows))), links)
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return [(i, count[i], low[i], low[i] == i) for i in range(len(rows))]


@pytest.mark.parametrize("tile", [8, 1024])
def test_against_all_pairs(spark, tile):
    rows = vectors()
    frame = spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], SCHEMA)
    found = sorted(map(tuple, embedding_dedup.near_duplicates(frame, tile=tile).collect()))
    assert found == expected(rows)
    assert sum(n for _, n, _, _ in found) > 1000


def test_empty_and_null_ids(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, [1.0, 0.0], 1, 1, "t", 2, 3), (5, [1.0, 0.0], 1, 1, "t", 2, 3), (5, [1.0, 0.0], 1, 1, "t", 2, 3)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]
