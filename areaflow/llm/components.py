"""Connected components of an edge table.

Every task first replaces its edges by a spanning forest, at most one edge per
vertex.  A forest of a checked, bounded size is finished by one task.  A larger
one is finished by stars that shrink: each round links every vertex to the
smallest neighbour it knows and to that neighbour's own, until no label changes;
a round moves one row per edge, minima combine before the shuffle, so a vertex
with very many edges is no burden, and rounds are cut off by checkpoints in the
shared folder.  Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session

#: Edges that one task may finish: 32 MB.
ONE_TASK = 2_000_000


def labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends of the edges, ascending, and the smallest end reachable from each."""
    ends, place = np.unique(np.r_[a, b], return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    low = np.arange(len(ends))
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            return ends, ends[low]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while True:
            next_ = low[low]
            if (next_ == low).all():
                break
            low = next_


def _whole(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in parts]), np.concatenate([q for _, q in parts])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every million edges a forest of their own."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > 1_000_000:
            yield _star(held)
            held, rows = [], 0
    yield _star(held)


def _star(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    v, low = labels(*_whole(iter(batches)))
    return pa.RecordBatch.from_arrays([pa.array(v[v != low]), pa.array(low[v != low])], names=["a", "b"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    v, low = labels(*_whole(batches))
    yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(low)], names=["v", "component"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """``edges(a, b)``, long and in any direction; gives ``v, component``, the smallest vertex reachable, for every end.

    A vertex is among the ends if an edge leads to another vertex.
    """
    apart = edges.select("a", "b").filter("a <> b")
    forest, _ = session.staged(apart.mapInArrow(_forest, "a long, b long"), "forest")
    if forest.count() <= one_task:
        found, _ = session.staged(forest.coalesce(1).mapInArrow(_finish, "v long, component long"), "components")
        return found
    return _stars(forest)


def _stars(edges: DataFrame) -> DataFrame:
    context = edges.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(session.scratch(edges.sparkSession, "checkpoints"))
    current = edges.distinct().checkpoint()
    while True:
        # large star: neighbours above a vertex go to the least vertex it knows
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").filter("b > a AND b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        # small star: neighbours below a vertex, and itself, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", "low"))
        after = small.filter("a > b").distinct().checkpoint()
        # finished when every vertex has one edge, to a vertex that has none
        ends = after.select("a").distinct()
        if after.count() == ends.count() and after.join(ends.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        current = after
    lows = after.select("b").distinct().select(F.col("b").alias("v"), F.col("b").alias("component"))
    return after.select(F.col("a").alias("v"), F.col("b").alias("component")).union(lows)
