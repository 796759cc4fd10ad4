"""Centroid clustering of integer vectors, with Ptolemaic pivots.

Some points are fixed as pivots, and every vector's distances from them are computed once
and kept beside it. For a vector x, a centroid c and a pair of pivots p, s, Ptolemy's
inequality gives

    |x - c| >= | |x - p| |c - s| - |x - s| |c - p| | / |p - s|

so that the cached distances bound the distance of every centroid from below without a
look at the components. In each round a vector starts from the centroid of its smallest
bound; the centroids whose bound is beyond the distance found are left out, the survivors
are computed exactly. Bounds are rounded down and distances up by more than arithmetic
can err, and what decides (distances, ties, sums, means) is integer arithmetic, so that
the result is the one of a full comparison.

A round reads the written vectors once. Tasks add up their vectors by cluster, so that a
cluster with a third of all rows sends one row per task to the next step; the driver holds
the centroids (k times the dimensions), never rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.tables import empty, stored

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
PIVOTS = 5  # points whose pairs give the bounds
MOST = 1 << 27  # of a scaled component: squared distances and sums then fit a long
ROWS = 4096  # vectors compared at once
EPS = 2.0**-46  # above the relative error of a few steps of double arithmetic


class Pivots(NamedTuple):
    """Fixed points (integers), and the pairs of them that differ, with their distance."""

    points: np.ndarray
    pairs: list[tuple[int, int, float]]


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows from an integer point."""
    apart = rows - point
    return np.einsum("ij,ij->i", apart, apart)


def pivots_of(centroids: np.ndarray, n: int) -> Pivots:
    """``n`` of the points, each the one farthest from those before it."""
    chosen = [0] if len(centroids) else []
    while len(chosen) < min(n, len(centroids)):
        nearest = np.min([squared(centroids, centroids[i]) for i in chosen], axis=0)
        if not nearest.max():
            break  # the others repeat them
        chosen.append(int(nearest.argmax()))
    points = centroids[chosen]
    pairs = [(i, j, float(squared(points[i : i + 1], points[j])[0]) ** 0.5) for i, j in itertools.combinations(range(len(points)), 2)]
    return Pivots(points, pairs)


def distances(rows: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Of each row from each pivot, rounded to the nearest double."""
    return np.stack([np.sqrt(squared(rows, p).astype(float)) for p in pivots.points], axis=1)


def lower_bounds(cached: np.ndarray, of_centroid: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Of each row's distance from one centroid; never above it, whatever rounding does."""
    best = np.zeros(len(cached))
    for i, j, apart in pivots.pairs:
        one, other = cached[:, i] * of_centroid[j], cached[:, j] * of_centroid[i]
        sure = np.abs(one - other) - EPS * (one + other)
        np.maximum(best, sure / (apart * (1 + EPS)), out=best)
    return best * (1 - EPS)


def nearest(rows: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the nearest centroid (of equal ones the first), the squared distance, and
    how many distances were computed for it."""
    computed = np.ones(len(rows), np.int64)
    of_centroids = distances(centroids, pivots)
    bounds = np.stack([lower_bounds(cached, d, pivots) for d in of_centroids], axis=1)
    start = bounds.argmin(axis=1)
    apart = rows - centroids[start]
    cluster, best = start.copy(), np.einsum("ij,ij->i", apart, apart)
    np.square(bounds, out=bounds)
    bounds *= 1 - EPS
    for c in range(len(centroids)):
        # One equally near and earlier must be seen, too: only what is farther is left out.
        seen = np.flatnonzero((bounds[:, c] <= best * (1 + EPS)) & (start != c))
        computed[seen] += 1
        own = squared(rows[seen], centroids[c])
        better = (own < best[seen]) | ((own == best[seen]) & (c < cluster[seen]))
        best[seen[better]], cluster[seen[better]] = own[better], c
    return cluster, best, computed


def scaled(vector: Column, scale: int) -> Column:
    """Components as integers: the floor of ``scale`` times each, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).try_cast("int"))


def kept_vectors(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, at): the integer vectors of those with all components in place."""
    whole = F.transform("vector", lambda x: x.cast("double"))
    good = F.forall(whole, lambda x: F.coalesce(F.abs(x * F.lit(float(scale))) < F.lit(float(MOST)), F.lit(False)))
    return vectors.where(F.coalesce((F.size("vector") == dimensions) & good, F.lit(False))).select("vec_id", scaled(F.col("vector"), scale).alias("at"))


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _parts(batch: pa.RecordBatch, width: int, pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for first in range(0, batch.num_rows, ROWS):
        part = batch.slice(first, ROWS)
        yield part, _matrix(part.column(1), np.int64, width), _matrix(part.column(2), float, pivots)


def _cached(pivots: Pivots, width: int):
    """Adds the distances from the pivots, as ``cached``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = distances(_matrix(batch.column(1), np.int64, width), pivots)
            ends = pa.array(np.arange(len(apart) + 1, dtype=np.int32) * apart.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(apart.reshape(-1)))], ["vec_id", "at", "cached"]
            )

    return run


def _added_up(centroids: np.ndarray, pivots: Pivots):
    """Of a task's vectors: for each cluster and dimension how many, and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = centroids.shape
        counts, sums, rows = np.zeros(k, np.int64), np.zeros((k, width), np.int64), 0

        def part() -> pa.RecordBatch:
            held = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(held, width).astype(np.int32)),
                    pa.array(np.tile(np.arange(width, dtype=np.int32), len(held))),
                    pa.array(np.repeat(counts[held], width)),
                    pa.array(sums[held].reshape(-1)),
                ],
                ["cluster", "dimension", "n", "total"],
            )

        for batch in batches:
            for _, at, cached in _parts(batch, width, len(pivots.points)):
                cluster, _, _ = nearest(at, cached, centroids, pivots)
                np.add.at(sums, cluster, at)
                counts += np.bincount(cluster, minlength=k)
                rows += len(at)
            if rows > 1 << 32:  # before a sum could leave a long
                yield part()
                counts[:], sums[:], rows = 0, 0, 0
        yield part()

    return run


def _assigned(centroids: np.ndarray, pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at, cached in _parts(batch, centroids.shape[1], len(pivots.points)):
                cluster, best, computed = nearest(at, cached, centroids, pivots)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cluster.astype(np.int32)), pa.array(best), pa.array(computed)],
                    ["vec_id", "cluster", "distance", "compared"],
                )

    return run


def _first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "at").limit(k).select("at").collect()  # k rows
    return np.array([r.at for r in rows], np.int64)


def _moved(kept: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The centroids as the floors of their vectors' means; those of no vector stay."""
    parts = kept.mapInArrow(_added_up(centroids, pivots), "cluster int, dimension int, n long, total long")
    wide = F.col("total").cast("decimal(38,0)")
    sums = parts.groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum(wide).alias("total"))
    moved = centroids.copy()
    for r in sums.collect():  # k times the dimensions
        moved[r.cluster, r.dimension] = int(r.total) // r.n
    return moved


def clusters(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 1,
    pivots: int = PIVOTS, vec_id: str = "vec_id", embedding: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """Per kept vector: vec_id, cluster, distance (squared), compared (the
    distances computed for it in the last assignment); and the final centroids.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite, and all
    below 2**27 in size once scaled (larger ones would not give distances that a long
    holds); others are left out. Component x becomes the integer floor(scale * x). The first
    centroids are the ``k`` kept vectors with the smallest SHA-256 of "seed:vec_id"; rows of
    one id go by their components, rows without an id come last. In each round every
    vector goes to its nearest centroid (of equal ones the one of the smaller number), then
    each centroid with vectors moves to the componentwise floor of their mean.

    Repeated rows count and are returned each; fewer than ``k`` vectors give as many
    centroids; no vectors give no rows. Other columns are not looked at. The driver holds
    k * dimensions integers.
    """
    table = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    kept = kept_vectors(table, dimensions, scale)
    centroids = _first_centroids(kept, k, seed)
    if not len(centroids):
        return empty(vectors.sparkSession, "vec_id long, cluster int, distance long, compared long"), centroids
    fixed = pivots_of(centroids, pivots)
    cached = stored(kept.mapInArrow(_cached(fixed, dimensions), "vec_id long, at array<int>, cached array<double>"), "vectors")
    for _ in range(rounds):
        centroids = _moved(cached, centroids, fixed)
    found = cached.mapInArrow(_assigned(centroids, fixed), "vec_id long, cluster int, distance long, compared long")
    return found, centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``clusters`` (vec_id, cluster, distance) with cluster_inertia and inertia, the sums of
    the distances of a cluster and of all, and centroid_sha256: of the components of the
    cluster's centroid in decimal, joined by commas."""
    found = stored(found.select("vec_id", "cluster", "distance"), "clusters")
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    if not sums:
        nothing = F.lit(None).cast("long")
        return found.withColumns({"cluster_inertia": nothing, "inertia": nothing, "centroid_sha256": F.lit(None).cast("string")})
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return found.withColumns(
        {
            "cluster_inertia": by_cluster([sums.get(c, 0) for c in range(len(centroids))], "long"),
            "inertia": F.lit(sum(sums.values())).cast("long"),
            "centroid_sha256": by_cluster(digests, "string"),
        }
    )
