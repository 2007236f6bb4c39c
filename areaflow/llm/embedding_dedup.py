"""Cosine near-duplicates of vectors with equal labels, by PCA-ordered tiles.

Vectors are scaled to length one and turned onto the principal axes of all
vectors, so that leading dimensions carry most of a product.  Unit vectors whose
cosine reaches the threshold differ by at most ``width`` on any axis, so a vector
is only compared within its cell of the two leading axes and the cells beside
it.  Cells are cut into tiles of bounded size.  A pair of tiles adds up products
over blocks of dimensions, bounds the rest by the norms of what is left, drops
pairs that cannot reach the threshold, and stops when none is left; pairs that
remain are decided by the cosine of the original vectors in double precision.

Equal vectors of a label are one class first: their links among each other follow
from the class size, so a vector that makes up much of the table is compared once.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, rows without a label, and rows without an id link with nothing and
are a component of their own; vectors of different length do not link; rows that
repeat an id count as vectors of their own and share a component; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm.components import components

THRESHOLD = 0.98
#: Vectors of a tile; a pair of tiles is one task's unit of work.
TILE = 1024
#: Dimensions added up between two prunings.
BLOCK = 8
#: Room for rounding in bounds that only prune.
_SLACK = 1e-9


def _usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``id, label, x``: double vectors that can link."""
    x = F.col("x")
    narrow = vectors.select(
        vectors[vec_id].alias("id"), vectors[label].alias("label"),
        vectors[embedding].cast("array<double>").alias("x"),
    )
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    return narrow.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
    )


def _moments(classes: DataFrame) -> dict[int, np.ndarray]:
    """Second moments of the unit vectors by dimension; a task sends one matrix per dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in batch.column("x").to_pylist():
                u = _unit(np.array([x]))[0]
                sums.setdefault(len(u), np.zeros((len(u), len(u))))
                sums[len(u)] += np.outer(u, u)
        for d, m in sums.items():
            at = np.arange(d)
            columns = [pa.array(np.full(d, d)), pa.array(at), pa.array(list(m), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "i", "row"])

    rows = classes.select("x").mapInArrow(task, "d long, i long, row array<double>")
    flat = rows.select("d", "i", F.posexplode("row").alias("j", "v"))
    total = flat.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    found = {}
    for d, part in total.groupby("d"):
        found[int(d)] = np.zeros((int(d), int(d)))
        found[int(d)][part["i"], part["j"]] = part["v"]
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _axes(moments: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for d, m in moments.items()}


def _tile_links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` (original vectors) whose cosine reaches the threshold."""
    ua, ub = _unit(a), _unit(b)
    pa_, pb = ua @ axes, ub @ axes
    d = axes.shape[0]
    rest_a = np.sqrt(np.maximum(0, np.cumsum((pa_ * pa_)[:, ::-1], axis=1)[:, ::-1]))
    rest_b = np.sqrt(np.maximum(0, np.cumsum((pb * pb)[:, ::-1], axis=1)[:, ::-1]))
    first = min(BLOCK, d)
    product = pa_[:, :first] @ pb[:, :first].T
    bound = product + np.outer(rest_a[:, first], rest_b[:, first]) if first < d else product
    i, j = np.nonzero(bound >= threshold - _SLACK)
    total = product[i, j]
    for start in range(first, d, BLOCK):
        if not len(i):
            break
        stop = min(start + BLOCK, d)
        total = total + np.einsum("ij,ij->i", pa_[i, start:stop], pb[j, start:stop])
        if stop < d:
            open_ = total + rest_a[i, stop] * rest_b[j, stop] >= threshold - _SLACK
            i, j, total = i[open_], j[open_], total[open_]
    if not len(i):
        return i, j
    near = total >= threshold - 1e-6
    i, j = i[near], j[near]
    cosine = np.einsum("ij,ij->i", a[i], b[j])
    cosine /= np.sqrt(np.einsum("ij,ij->i", a[i], a[i])) * np.sqrt(np.einsum("ij,ij->i", b[j], b[j]))
    odd = ~np.isfinite(cosine)  # squares of extreme components overflow; unit vectors do not
    cosine[odd] = np.einsum("ij,ij->i", ua[i[odd]], ub[j[odd]])
    linked = cosine >= threshold
    return i[linked], j[linked]


def links(classes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Linked classes: ``id, n`` with the sizes of the linked classes added up, and edges ``a, b`` that connect them.

    ``classes`` has ``id, label, x, size``.  A pair of tiles gives a forest, not all its pairs.
    """
    axes = _axes(_moments(classes))
    shared = classes.sparkSession.sparkContext.broadcast(axes)
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = [], []
            for v in batch.column("x").to_pylist():
                lead = _unit(np.array([v]))[0] @ shared.value[len(v)][:, :2]
                x.append(int(np.floor(lead[0] / width)))
                y.append(int(np.floor(lead[1] / width)) if len(lead) > 1 else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(x, pa.int32()), pa.array(y, pa.int32())], names=[*batch.schema.names, "cx", "cy"]
            )

    placed = classes.mapInArrow(cells, classes.schema.simpleString()[7:-1] + ", cx int, cy int")
    placed = placed.withColumn("d", F.size("x"))
    placed, _ = session.staged(placed, "cells")
    key = ["label", "d", "cx", "cy"]
    tiles = placed.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    dealt = placed.join(tiles, key).withColumn("t", F.pmod(F.xxhash64("id"), F.col("tiles")))
    # each unordered pair of cells is named by its smaller cell; a cell meets half of its neighbours, and itself
    halves = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    offsets = F.array(*[F.struct(F.lit(a).alias("ox"), F.lit(b).alias("oy")) for a, b in halves])
    home = dealt.withColumn("o", F.explode(offsets)).select(
        "label", "d", "cx", "cy", "o.ox", "o.oy", "id", "x", "size", "t", F.lit(0).alias("side"), "tiles"
    )
    away = dealt.withColumn("o", F.explode(F.slice(offsets, 2, len(halves) - 1))).select(
        "label", "d", (F.col("cx") - F.col("o.ox")).alias("cx"), (F.col("cy") - F.col("o.oy")).alias("cy"),
        "o.ox", "o.oy", "id", "x", "size", "t", F.lit(1).alias("side"), "tiles",
    )
    pair = [*key, "ox", "oy"]
    # a row goes to every tile of the other cell; within a cell, to the pairs of tiles that hold its own
    sides = home.union(away)
    counts = sides.groupBy(pair).agg(
        F.coalesce(F.max(F.when(F.col("side") == 0, F.col("tiles"))), F.lit(0)).alias("home_tiles"),
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("tiles"))), F.lit(0)).alias("away_tiles"),
    )
    counts = counts.filter("home_tiles > 0 AND (away_tiles > 0 OR (ox = 0 AND oy = 0))")
    own_cell = (F.col("ox") == 0) & (F.col("oy") == 0)
    other = F.when(own_cell, F.col("home_tiles")).otherwise(
        F.when(F.col("side") == 0, F.col("away_tiles")).otherwise(F.col("home_tiles"))
    )
    spread = sides.join(counts, pair).withColumn("u", F.explode(F.sequence(F.lit(0).cast("long"), other - 1)))
    low = F.when(own_cell, F.least("t", "u")).otherwise(F.when(F.col("side") == 0, F.col("t")).otherwise(F.col("u")))
    high = F.when(own_cell, F.greatest("t", "u")).otherwise(F.when(F.col("side") == 0, F.col("u")).otherwise(F.col("t")))
    left = F.when(own_cell, F.col("t") == low).otherwise(F.col("side") == 0)
    units = spread.select(*pair, low.alias("low"), high.alias("high"), left.alias("left"), own_cell.alias("own"), "id", "x", "size")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, low_, high_ = bool(group["own"].iloc[0]), int(group["low"].iloc[0]), int(group["high"].iloc[0])
        lefts = group[group["left"]]
        inner = own and low_ == high_
        rights = lefts if inner else group[~group["left"]]
        empty = {"id": [], "n": [], "root": []}
        if not len(lefts) or not len(rights):
            return pd.DataFrame(empty)
        a = np.stack(lefts["x"].to_list())
        b = a if inner else np.stack(rights["x"].to_list())
        i, j = _tile_links(a, b, shared.value[a.shape[1]], threshold)
        if inner:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return pd.DataFrame(empty)
        ids_a, ids_b = lefts["id"].to_numpy(), rights["id"].to_numpy()
        size_a, size_b = lefts["size"].to_numpy(), rights["size"].to_numpy()
        ids = np.r_[ids_a, ids_b]
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, i, size_b[j])
        np.add.at(n, len(ids_a) + j, size_a[i])
        parent = {}

        def root(v):
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for p, q in zip(ids_a[i].tolist(), ids_b[j].tolist(), strict=True):
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
        linked = np.flatnonzero(n)
        return pd.DataFrame({"id": ids[linked], "n": n[linked], "root": [root(v) for v in ids[linked].tolist()]})

    found = units.groupBy(*pair, "low", "high").applyInPandas(compare, "id long, n long, root long")
    found, _ = session.staged(found, "links")
    return found.groupBy("id").agg(F.sum("n").alias("n")), found.select(F.col("id").alias("a"), F.col("root").alias("b"))


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    usable = _usable(vectors, vec_id, embedding, label)
    classes = usable.groupBy("label", "x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
    classes, _ = session.staged(classes, "classes")
    counted, edges = links(classes.select("id", "label", "x", "size"), threshold, tile)
    joined = components(edges)
    classes = classes.join(counted, "id", "left").join(joined, classes["id"] == joined["v"], "left").select(
        "label", "x", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    members = usable.join(classes, ["label", "x"]).select("id", "n_links", "component_id")
    rest = vectors.select(vectors[vec_id].alias("id")).join(members.select("id").distinct(), "id", "left_anti")
    lone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    everything = members.union(lone)
    kept = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    return everything.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept)
