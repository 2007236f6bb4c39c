from __future__ import annotations

import random

import pytest

from areaflow.llm.components import components
from tests.llm import docs


@pytest.mark.parametrize("one_task", [0, 1 << 20])
def test_against_a_loop(spark, one_task):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(100, 140)] + [(500, 501 + k) for k in range(300)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges] * 2
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    ends = {v for a, b in edges if a != b for v in (a, b)}
    low = docs.smallest(list({v for e in edges for v in e}), edges)
    assert dict(map(tuple, components(frame, one_task).collect())) == {v: low[v] for v in ends}


@pytest.mark.parametrize("one_task", [-1, 10])
def test_no_edges(spark, one_task):
    assert components(spark.createDataFrame([], "a long, b long"), one_task).count() == 0
