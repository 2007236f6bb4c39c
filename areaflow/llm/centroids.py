"""Exact k-means over whole-number vectors; centroids are filtered by n-simplex bounds.

A few pivots, taken from the starting centroids, span a simplex.  A vector's
distances to them, computed once and stored with it, place it as the apex over that
simplex: coordinates of which the last is its height above the pivots' span.  The
distance of two apexes is a lower bound of the vectors' own, and with one height turned
over an upper one.  A centroid whose lower bound lies above the least upper bound cannot be
the nearest; the squared distances to those that remain are exact integers.

A round is one pass over the stored vectors.  Every task hands on one sum and count
per centroid, so a cluster that holds most vectors is no burden; the driver sees ``k``
centroids and their sums.

Defined results: vectors that are null, of another length than ``size``, or that hold null
or non-finite components are left out; equal distances go to the smaller number; an
empty centroid stays where it is; rows that repeat an id are vectors of their own, and of
equal starting hashes the smaller vector comes first; rows without an id are clustered,
but start no centroid; with fewer vectors than ``k`` there are as many centroids; an empty
table gives no rows.  Components beyond +-2**27 after scaling raise an error, as
squared distances would leave 64 bits.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import session

K = 40
ROUNDS = 5
SIZE = 64
SCALE = 256
SEED = "2"
#: Pivots of the simplex.
PIVOTS = 16
#: Largest component: squared distances of up to 64 components stay below 2**62.
LARGEST = 1 << 27
#: Height a pivot needs above the ones before it, as a share of the largest distance.
_LEAST_HEIGHT = 1e-2
#: Room for rounding in bounds that only leave centroids out.
_SLACK = 1e-7
#: Vectors compared at once inside a task.
_BLOCK = 4096


def start_hash(vec_id: Column, seed: str = SEED) -> Column:
    """Centroids start as the vectors with the smallest of these."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def whole_vectors(
    vectors: DataFrame, size: int = SIZE, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``vec_id, v``: the vectors that are kept, as whole numbers."""
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    narrow = vectors.select(vectors[vec_id].alias("vec_id"), vectors[embedding].cast("array<double>").alias("x"))
    kept = narrow.filter((F.size(x) == size) & finite)
    inside = F.forall(x, lambda c: F.abs(F.floor(c * scale)) <= LARGEST)
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling by {scale}"))
    # floor of a double is a long, so what does not fit is refused before the cast
    whole = F.transform(F.when(F.forall(x, lambda c: F.abs(c) <= LARGEST / scale) & inside, x).otherwise(too_large),
                        lambda c: F.floor(c * scale).cast("int"))
    return kept.select("vec_id", whole.alias("v"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two whole-number matrices, pair by pair."""
    d = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", d, d)


class Simplex:
    """Pivots in general position; turns distances to them into apex coordinates."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        """Takes pivots from ``points``, each as far as possible above the span of those before."""
        self.pivots = points[:1].astype(np.int64)
        self.base = np.zeros((1, 0))
        widest = float(max((self._to(points[:1], p) for p in points), default=[0.0])[0]) ** 0.5 if len(points) else 0.0
        while len(points) and len(self.pivots) < most:
            apexes = self.apexes(self.distances(points))
            best = int(np.argmax(apexes[:, -1]))
            if apexes[best, -1] <= _LEAST_HEIGHT * widest or apexes[best, -1] <= 0:
                break
            self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apexes[best]])
            self.pivots = np.vstack([self.pivots, points[best]])

    @staticmethod
    def _to(a: np.ndarray, b: np.ndarray) -> list[float]:
        return squared(a, b[None, :]).astype(float).tolist()

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Squared distances to every pivot, a column each."""
        return np.stack([squared(v, p[None, :]) for p in self.pivots], axis=1)

    def apexes(self, square: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances: one per pivot, the last being the height."""
        square = square.astype(np.float64)
        steps = len(self.pivots) - 1
        at = np.zeros((len(square), steps + 1))
        # the first pivot is the origin; every further one adds one coordinate to the simplex
        for i in range(1, steps + 1):
            known = self.base[i, : i - 1]
            norm = float(self.base[i] @ self.base[i])
            inner = (square[:, 0] - square[:, i] + norm) / 2 - at[:, : i - 1] @ known
            at[:, i - 1] = inner / self.base[i, i - 1]
        at[:, -1] = np.sqrt(np.maximum(0.0, square[:, 0] - (at[:, :-1] ** 2).sum(axis=1)))
        return at


class Nearest:
    """The nearest centroid of vectors given with their apexes."""

    def __init__(self, simplex: Simplex, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        self.apexes = simplex.apexes(simplex.distances(self.centroids))

    def __call__(self, v: np.ndarray, apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The number and exact squared distance of each, and how many distances were computed."""
        number, distance, compared = [], [], 0
        for at in range(0, len(v), _BLOCK):
            own, height = apexes[at : at + _BLOCK, :-1], apexes[at : at + _BLOCK, -1:]
            other, top = self.apexes[:, :-1], self.apexes[:, -1]
            inner = (own**2).sum(1)[:, None] + (other**2).sum(1)[None, :] - 2 * own @ other.T
            lower, upper = inner + (height - top) ** 2, inner + (height + top) ** 2
            # all terms a bound is made of, whose rounding it carries
            room = _SLACK * ((own**2).sum(1)[:, None] + (other**2).sum(1)[None, :] + height**2 + top**2 + 1)
            row, column = np.nonzero(lower - room <= (upper + room).min(axis=1)[:, None])
            exact = squared(v[at : at + _BLOCK][row], self.centroids[column])
            compared += len(exact)
            # pairs come by row, then centroid: the first of the least is the smaller number
            starts = np.searchsorted(row, np.arange(len(own)))
            least = np.minimum.reduceat(exact, starts)
            hits = np.flatnonzero(exact == least[row])
            first = hits[np.searchsorted(row[hits], np.arange(len(own)))]
            number.append(column[first])
            distance.append(least)
        return np.concatenate(number), np.concatenate(distance), compared


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(len(column), -1)


def placed(whole: DataFrame, simplex: Simplex) -> DataFrame:
    """Adds ``apex`` to whole vectors."""
    kind = whole.schema["vec_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = simplex.apexes(simplex.distances(_matrix(batch.column("v"), np.int64)))
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(apexes) + 1) * apexes.shape[1], pa.int32()), pa.array(apexes.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, "apex"])

    return whole.mapInArrow(task, f"vec_id {kind}, v array<int>, apex array<double>")


def _sums(ready: DataFrame, nearest: Nearest) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of every centroid that has vectors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = nearest.centroids.shape
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), np.int64)
                number, _, _ = nearest(v, _matrix(batch.column("apex"), np.float64))
                counts += np.bincount(number, minlength=k)
                order = np.argsort(number, kind="stable")
                own, first = np.unique(number[order], return_index=True)
                sums[own] += np.add.reduceat(v[order], first, axis=0)
        own = np.flatnonzero(counts)
        at = np.repeat(own, size)
        columns = [at, np.tile(np.arange(size), len(own)), np.repeat(counts[own], size), sums[own].ravel()]
        names = ["cluster", "component", "n", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    parts = ready.mapInArrow(task, "cluster long, component long, n long, total long")
    total = parts.groupBy("cluster", "component").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for row in total.orderBy("cluster", "component").collect():
        found.setdefault(row.cluster, (int(row.n), []))[1].append(int(row.total))
    return found


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: str = SEED,
    pivots: int = PIVOTS, vec_id: str = "vec_id", embedding: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance, compared`` of every kept vector, and the final centroids.

    ``compared`` is the share of centroids whose exact distance was needed in the vector's batch.
    """
    whole = whole_vectors(vectors, size, scale, vec_id, embedding)
    first = whole.filter("vec_id is not null").orderBy(start_hash(F.col("vec_id"), seed), "v").limit(k)
    centroids = np.array([row.v for row in first.collect()], np.int64).reshape(-1, size)
    kind = whole.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, compared double"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    simplex = Simplex(centroids, pivots)
    ready, _ = session.staged(placed(whole, simplex), "apexes")
    for _round in range(rounds):
        for number, (n, total) in _sums(ready, Nearest(simplex, centroids)).items():
            centroids[number] = [t // n for t in total]
    nearest = Nearest(simplex, centroids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance, compared = nearest(
                    _matrix(batch.column("v"), np.int64), _matrix(batch.column("apex"), np.float64)
                )
                share = np.full(len(number), compared / (len(number) * len(nearest.centroids)))
                columns = [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance), pa.array(share)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "compared"])

    assigned, _ = session.staged(ready.mapInArrow(task, schema), "assigned")
    return assigned, centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the joined side has ``k`` rows."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = sum(int(row.total) for row in sums)
    digest = {i: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for i, c in enumerate(centroids)}
    rows = [(row.cluster, int(row.total), whole, digest[row.cluster]) for row in sums]
    described = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(described), "cluster")
