"""Near-duplicate vectors by an inverted multi-index.

Each half of a unit vector has its own codebook; a pair of codes is a cell of the product
grid, and an inverted list holds the vectors of a cell. A query visits cells in the order
of their distance (multi-sequence traversal of the two sorted code lists), up to a reach
that misses no pair. A cell's distance is how far the query's halves lie from the planes
that part the cell's codes from the query's own, added up. What is found is verified by
the cosine.

A pair is found when either of the two visits the other's cell. In each half the two lie on
opposite sides of one plane, so that their distances from it, a and b, make at most the
distance of the halves: (a1 + b1)^2 + (a2 + b2)^2 <= |x - y|^2 <= 2 - 2 * similarity. Then
(a1 + a2) + (b1 + b2) <= 2 * sqrt(1 - similarity), and the smaller of the two sums is
at most sqrt(1 - similarity): the reach.

Cells are searched in blocks of bounded size, points against queries, so that a crowded
cell is dealt to many tasks. A block returns counts and a spanning forest of its links,
never the links of all pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.llm import graph
from userflow.llm.tables import stored

SAMPLE_ROWS = 20000  # vectors that the codebooks are fitted on, or CODE_ROWS for each code if that is more
CODE_ROWS = 16
LEAST_CODES, MOST_CODES = 4, 8192  # enough for four billion vectors
CELL_ROWS = 64
ROUNDS = 12  # of k-means
AT_ONCE = 1 << 22  # distances of vectors and codes that are held at once
BLOCK_ROWS = 512  # points, and queries, that one block holds on average
CLOSE = 1e-3  # codes nearer to each other are not parted, their plane cannot be told exactly
SLACK = 1e-6  # of the reach, far above what rounding makes of the distances


class Index(NamedTuple):
    """Codebooks of the two halves, and the greatest distance of a visited cell."""

    split: int
    codes: tuple[np.ndarray, np.ndarray]
    most: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.split], x[:, self.split :]

    def own(self, x: np.ndarray) -> list[np.ndarray]:
        return [_nearest(h, c) for h, c in zip(self.halves(x), self.codes, strict=True)]

    def least(self, x: np.ndarray) -> list[np.ndarray]:
        return [_least(h, c) for h, c in zip(self.halves(x), self.codes, strict=True)]


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, as rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(2)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            x = _matrix(column.take(pa.array(rows))).astype(float)  # a null component becomes NaN
            most = np.abs(x).max(1)
            able = np.isfinite(most) & (most > 0)
            # Divided by the largest component first, so that no square leaves the range.
            x, rows = x[able] / most[able, None], rows[able]
            x = x / np.sqrt((x * x).sum(1))[:, None] + 0.0
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(np.full(len(rows), size), pa.int32()),
                    pa.array([hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * size, pa.int32()), pa.array(x.ravel())),
                ],
                ["vec_id", "label", "size", "mark", "unit"],
            )


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared, one row for each x."""
    apart = (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)[None, :]
    return np.maximum(apart, 0)


def _slices(rows: int, codes: int) -> Iterator[slice]:
    """Slices of some rows whose distances from the codes may be held at once."""
    step = max(1, AT_ONCE // codes)
    return (slice(at, at + step) for at in range(0, rows, step))


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[own], codes).argmin(1) for own in _slices(len(x), len(codes))])


def _codebook(x: np.ndarray, n: int) -> np.ndarray:
    draw = np.random.default_rng(0)
    codes = x[draw.choice(len(x), min(n, len(x)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(x, codes)
        held = np.bincount(nearest, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, x)
        codes = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], codes)
    return codes


def _least(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Distance of each x to the plane between each code and its nearest one."""
    squared = _distances(x, codes)
    near = squared.argmin(1)
    kinds, at = np.unique(near, return_inverse=True)
    between = np.sqrt(_distances(codes[kinds], codes))[at]
    plane = (squared - squared[np.arange(len(x)), near][:, None]) / (2 * np.where(between > CLOSE, between, np.inf))
    return np.maximum(plane, 0)


def _reach(similarity: float) -> float:
    """Distance up to which one of any two vectors at least so similar visits the other's cell."""
    return math.sqrt(max(0.0, 1 - similarity)) + SLACK


def visited(first: np.ndarray, second: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Multi-sequence traversal: pairs of codes by ascending sum of their bounds, while
    the sum is at most ``most``."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    cells, heap, seen = [], [(first[by_first[0]] + second[by_second[0]], 0, 0)], {(0, 0)}
    while heap:
        least, i, j = heapq.heappop(heap)
        if least > most:
            break
        cells.append((int(by_first[i]), int(by_second[j])))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[by_first[a]] + second[by_second[b]], a, b))
    return cells


def _visits(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
    x = _matrix(batch.column("unit"))
    first, second = index.least(x)
    own = np.stack(index.own(x), axis=1)
    cells = [visited(a, b, index.most) for a, b in zip(first, second, strict=True)]
    rows = np.repeat(np.arange(len(x)), [len(c) for c in cells])
    codes = np.array([c for found in cells for c in found])
    taken = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("node").take(taken),
            batch.column("label").take(taken),
            pa.array(codes[:, 0], pa.int32()),
            pa.array(codes[:, 1], pa.int32()),
            pa.array((codes == own[rows]).all(1)),
        ],
        ["node", "label", "first", "second", "home"],
    )


def _cells(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A vector may visit hundreds of cells: few vectors at a time.
            widest = 8 * max(len(codes) for codes in index.codes)
            for part in _slices(batch.num_rows, widest):
                yield _visits(index, batch.slice(part.start, part.stop - part.start))

    return run


def _forest(linked: np.ndarray, points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) over the links of queries (rows) and points."""
    on_query, on_point = queries.copy(), points.copy()
    far = np.iinfo(np.int64).max
    while True:
        new_query = np.minimum(on_query, np.where(linked, on_point[None, :], far).min(1, initial=far))
        new_point = np.minimum(on_point, np.where(linked, new_query[:, None], far).min(0, initial=far))
        if (new_query == on_query).all() and (new_point == on_point).all():
            break
        on_query, on_point = new_query, new_point
    nodes, ends = np.concatenate([queries, points]), np.concatenate([on_query, on_point])
    return nodes[nodes != ends], ends[nodes != ends]


def _searched(index: Index, similarity: float):
    def run(rows: pa.Table) -> pa.Table:
        home = rows["home"].to_numpy()
        unit, node, copies = _matrix(rows["unit"]), rows["node"].to_numpy(), rows["copies"].to_numpy()
        x, y, at, to = unit[home], unit[~home], node[home], node[~home]
        linked = (y @ x.T >= similarity) & (to[:, None] != at[None, :])
        on = linked.any(1), linked.any(0)
        if on[0].any():  # only what has links goes on
            linked, x, y, at, to = linked[on[0]][:, on[1]], x[on[1]], y[on[0]], at[on[1]], to[on[0]]
            copies_at, copies_to = copies[home][on[1]], copies[~home][on[0]]
            # A point that visits its query's cell finds the pair there by itself.
            first, second = index.own(y)
            near, far = index.least(x)
            alone = linked & ~((near[:, first] + far[:, second]) <= index.most).T
            nodes, ends = _forest(linked, at, to)
            counts = linked @ copies_at, copies_to @ alone
            node = np.concatenate([to, at, nodes])
            return pa.table(
                {
                    "node": node,
                    "n_links": np.concatenate([*counts, np.zeros(len(nodes), np.int64)]),
                    "end": np.concatenate([to, at, ends]),
                }
            )
        none = pa.array([], pa.int64())
        return pa.table({"node": none, "n_links": none, "end": none})

    return run


def build(units: DataFrame, similarity: float, sample_rows: int = SAMPLE_ROWS) -> Index:
    """Codebooks fitted on at most ``sample_rows``, or CODE_ROWS for each code, of the (written,
    not empty) unit vectors, those with the smallest hashes; as many codes as make a cell of the
    grid hold CELL_ROWS on average, so that cells do not grow with the table. All vectors are
    indexed."""
    number = int(min(MOST_CODES, max(LEAST_CODES, math.sqrt(units.count() / CELL_ROWS))))
    most = max(sample_rows, CODE_ROWS * number)
    fetched = units.orderBy(F.xxhash64("node"), "node").limit(most).select("unit").toArrow()
    x = _matrix(fetched["unit"])
    split = max(1, x.shape[1] // 2)
    return Index(split, (_codebook(x[:, :split], number), _codebook(x[:, split:], number)), _reach(similarity))


def _linked(units: DataFrame, similarity: float) -> DataFrame:
    """(node, n_links, end): counts of each node's links, and forest links (node, end)."""
    index = build(units, similarity)
    cells = stored(
        units.select("node", "label", "unit").mapInArrow(
            _cells(index), "node long, label string, first int, second int, home boolean"
        ),
        "cells",
    )
    cell = ["label", "first", "second"]
    sizes = cells.groupBy(*cell).agg(
        F.ceil(F.count(F.when(F.col("home"), 1)) / BLOCK_ROWS).cast("int").alias("of_points"),
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("of_queries"),
        F.count(F.when(F.col("home"), 1)).alias("n"),
        F.count("*").alias("asked"),
    )
    # A cell with one vector that only itself asks for has nothing to compare.
    sizes = stored(sizes.where("n > 0 and asked > 1").drop("n", "asked"), "cell-sizes")
    dealt = stored(cells.join(sizes, cell), "dealt")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - F.lit(1).cast("long")))
    points = dealt.where("home").select(
        *cell, "node", "home", F.pmod(F.xxhash64("node"), "of_points").alias("p"), F.col("of_queries").alias("others")
    )
    queries = dealt.select(
        *cell, "node", F.lit(False).alias("home"), F.pmod(F.xxhash64("node"), "of_queries").alias("q"), F.col("of_points").alias("others")
    )
    points = points.select(*cell, "node", "home", "p", others.alias("q"))
    queries = queries.select(*cell, "node", "home", others.alias("p"), "q")
    blocks = points.unionByName(queries).join(units.select("node", "copies", "unit"), "node")
    return blocks.groupBy(*cell, "p", "q").applyInArrow(_searched(index, similarity), "node long, n_links long, end long")


def near_vectors(
    vectors: DataFrame, similarity: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str | None = "label"
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two vectors are linked when their labels are equal and not null and their cosine, in
    double precision, is at least ``similarity``; with ``label`` None all are compared.
    n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable, kept tells whether it is the row's own.

    A vector that is null, empty, zero, or holds a null or a number that is not finite,
    and one without a label or an id, is linked with nothing. Vectors of different
    lengths are not linked. Each row counts on its own, repeated ones too; of an id with
    several vectors each is judged by itself. A row without an id is kept, its
    component_id is null. Other columns are not looked at. An empty table gives an empty
    result.
    """
    given = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        (F.lit("") if label is None else F.col(label).cast("string")).alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    able = given.where("vec_id is not null and label is not null and embedding is not null")
    units = able.mapInArrow(_unit_rows, "vec_id long, label string, size int, mark binary, unit array<double>")
    rows = stored(units.withColumn("row", F.monotonically_increasing_id()), "units")
    # Equal vectors of a label are one node, so that copies never meet in a cell.
    classes = stored(
        rows.groupBy("label", "size", "mark").agg(
            F.min("row").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("unit").alias("unit")
        ),
        "classes",
    )
    found = vectors.sparkSession.createDataFrame([], "node long, n_links long, end long")
    for row in classes.select("size").distinct().collect():  # one for each length of a vector
        found = found.union(_linked(classes.where(F.col("size") == row[0]), similarity))
    found = stored(found, "found")
    counts = found.groupBy("node").agg(F.sum("n_links").alias("beyond"))
    parts = graph.components(found.where("node <> end").select(F.col("node").alias("a"), F.col("end").alias("b")))
    placed = stored(
        classes.drop("unit").join(counts, "node", "left").join(parts, "node", "left").select(
            "label", "size", "mark", "least",
            (F.coalesce("beyond", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "placed",
    )
    smallest = stored(placed.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    named = stored(placed.join(smallest, "component").select("label", "size", "mark", "n_links", "component_id"), "named")
    linked = rows.select("vec_id", "label", "size", "mark").join(named, ["label", "size", "mark"])
    linked = linked.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    # Rows that cannot be linked: all given ones without those above.
    usable = F.exists("embedding", lambda x: x != 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    able_row = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False))
    alone = given.where(~able_row).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.union(alone)
