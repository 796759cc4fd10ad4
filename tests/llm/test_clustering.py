import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from userflow.llm import clustering

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("cluster", T.StringType()),
        T.StructField("cached", T.IntegerType()),
    ]
)


def made(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1) for i, v in rows], SCHEMA)


def expected(rows, k, rounds, width, scale=64, seed=1):
    kept = [
        (i, [math.floor(float(np.float32(x)) * scale) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(row):
        i, at = row
        return (i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), at)

    centroids = [at for _, at in sorted(kept, key=order)[:k]]

    def nearest(at):
        return min((sum((a - b) ** 2 for a, b in zip(at, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, at in kept:
            groups.setdefault(nearest(at)[1], []).append(at)
        centroids = [[sum(x) // len(x) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    return [(i, nearest(at)[1], nearest(at)[0]) for i, at in kept], centroids


def checked(spark, rows, k=16, rounds=3, width=64, pivots=clustering.PIVOTS):
    found, centroids = clustering.clusters(made(spark, rows), k, rounds, width, pivots=pivots)
    want, own = expected(rows, k, rounds, width)
    got = clustering.with_inertia(found, centroids).collect()
    assert centroids.tolist() == own
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == sorted((str(i), c, d) for i, c, d in want)
    for r in got:
        assert r.inertia == sum(d for *_, d in want) and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, own[r.cluster])).encode()).hexdigest()
    return found


def vectors(n, width, draw, size=1.0):
    return [(i, [draw.gauss(0, size) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("pivots", [1, 2, 5])
def test_against_all_distances(spark, pivots):
    draw = random.Random(pivots)
    base = vectors(12, 64, draw)
    rows = [(100 + i, [x + draw.gauss(0, 0.05) for x in base[i % 12][1]]) for i in range(300)] + vectors(60, 64, draw)
    rows += [rows[3], rows[3], (None, rows[0][1]), (None, base[1][1]), (3, base[2][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [float("nan")] * 64), (904, [1.0] * 63 + [None]), (905, [float("-inf")] * 64)]
    found = checked(spark, rows, pivots=pivots)
    if pivots == 5:  # the bounds leave most centroids out
        assert found.agg({"compared": "sum"}).first()[0] < 0.5 * 16 * found.count()


def test_ties_and_equal_points(spark):
    rows = [(i, [float(i % 3 - 1)] * 2) for i in range(50)]
    checked(spark, rows, k=5, rounds=2, width=2)
    checked(spark, [(i, [0.25, -0.25]) for i in range(20)], k=4, rounds=2, width=2)


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_vectors_than_clusters(spark, n):
    checked(spark, vectors(n, 64, random.Random(n)))


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        found, centroids = clustering.clusters(made(spark, rows))
        out = clustering.with_inertia(found, centroids)
        assert out.collect() == [] and len(centroids) == 0
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("size", [1, 50, 1 << 20, clustering.MOST - 1])
def test_bounds_are_never_above_the_distance(size):
    draw = np.random.default_rng(size)
    points = draw.integers(-size, size + 1, (400, 8))
    points[200:] = points[draw.integers(0, 12, 200)] + draw.integers(-1, 2, (200, 8)) * draw.integers(0, 2, (200, 1))
    centroids = points[:12]
    pivots = clustering.pivots_of(centroids, 5)
    cached, of = clustering.distances(points, pivots), clustering.distances(centroids, pivots)
    for c, own in zip(centroids, of, strict=True):
        bound = clustering.lower_bounds(cached, own, pivots)
        exact = [sum((int(a) - int(b)) ** 2 for a, b in zip(p, c, strict=True)) for p in points]
        # bound <= sqrt(exact), in exact arithmetic
        assert all(n * n <= e * d * d for e, (n, d) in zip(exact, (b.as_integer_ratio() for b in bound.tolist()), strict=True))
