"""Quality ranking learnt from preference pairs, with a cut at a score quantile.

Each pair holds a text labelled good and one labelled bad. The chance that the good one
is preferred is a logistic function of the difference of their scores (Bradley-Terry),
and a score is linear in features of the text's form. The cut is the quantile of the
learning texts' scores that leaves the labelled share below it.

All labelled texts are learnt from, in all pairs of a good and a bad one. Their features are
stored in blocks, over which Spark adds up what a Newton step needs. What a text contributes
to its pairs follows from the scores of the other kind, which are counted at the nodes of a
grid; no pair is made.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm import labelled, words
from userflow.llm.tables import stored

SHRINK = 1e-3
ROUNDS = 50  # at most
CLOSE = 1e-7  # change of a weight at which the steps end
FAR = 6.0  # standard deviations at which a feature is cut off
BLOCK = 8192  # labelled texts of a block, until there are so many blocks
BLOCKS = 256
GRID = 1 / 32  # between the nodes at which scores are counted
COARSE = 64  # nodes for the bend of the loss, about; they decide how fast it ends, not where
BINS = 4096  # that a range of scores is cut into to find the cut


class Model(NamedTuple):
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float


def _shape(part: words.Slice) -> np.ndarray:
    """A row of numbers for each text, about its characters, words and repeats."""
    data, offsets = part.data, part.offsets

    def share(chosen: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(chosen)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / of

    size = np.maximum(np.diff(offsets), 1).astype(float)
    lower, upper = (data >= 97) & (data <= 122), (data >= 65) & (data <= 90)
    digit, far, line = (data >= 48) & (data <= 57), data >= 128, data == 10
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    marks = ~(lower | upper | digit | far | blank)
    usual = marks & np.isin(data, np.frombuffer(b".,;:'\"-()?", np.uint8))
    spaced, plain = words.words(part, words.SPACED), words.words(part, words.ALNUM)
    n = np.maximum(np.diff(spaced.bounds), 1).astype(float)
    triples = words.windows(spaced, 3)
    n_triples = np.maximum(np.diff(triples.bounds), 1)
    again = np.zeros(len(spaced.hashes))
    again[1:] = spaced.hashes[1:] == spaced.hashes[:-1]
    return np.stack(
        [
            np.log1p(n),
            share(lower | far, offsets, size),
            share(upper, offsets, size),
            share(digit, offsets, size),
            share(marks & ~usual, offsets, size),
            share(usual, offsets, size),
            share(blank, offsets, size),
            share(data == 124, offsets, size),
            share(data == 33, offsets, size),
            share(line, offsets, n),
            share(again, spaced.bounds, n),
            1 - np.diff(words.distinct(spaced).bounds) / n,
            1 - np.diff(words.distinct(triples).bounds) / n_triples,
            np.diff(plain.bounds) / n,
            size / n / 10,
        ],
        axis=1,
    )


WIDTH = 15


def _shapes(texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.empty((0, WIDTH)), *(_shape(part) for part in words.slices(texts))])


def _expanded(shapes: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((shapes - centre) / spread, -FAR, FAR)
    return np.concatenate([z, np.abs(z), z * z / FAR], axis=1)


def _spread_over(scores: np.ndarray, first: int, n: int, each: np.ndarray | None = None, step: float = GRID) -> np.ndarray:
    """Counts at n nodes, the first of them numbered ``first``: a score counts at the two
    nodes around it, more at the nearer. With ``each``, sums of its rows."""
    place = scores / step - first
    low = np.clip(np.floor(place).astype(np.int64), 0, n - 2)
    high = place - low
    if each is None:
        return np.bincount(low, 1 - high, n) + np.bincount(low + 1, high, n)
    parts = np.zeros((len(scores), n))
    at = np.arange(len(scores))
    parts[at, low], parts[at, low + 1] = 1 - high, high
    return parts.T @ each


def _each_block(blocks: DataFrame, told: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """What ``told`` makes of the labels and shapes of each block, in the order of blocks."""

    @F.arrow_udf("binary")
    def made(labels: pa.Array, shapes: pa.Array) -> pa.Array:
        out = []
        for own, rows in zip(labels, shapes, strict=True):
            x = np.frombuffer(rows.as_buffer(), "<f8").reshape(-1, WIDTH)
            out.append(told(np.frombuffer(own.as_buffer(), "i1") == 1, x).astype("<f8").tobytes())
        return pa.array(out, pa.binary())

    fetched = blocks.select("block", made("labels", "shapes").alias("made")).toArrow().sort_by("block")
    return [np.frombuffer(x.as_buffer(), "<f8") for x in fetched["made"]]


class _Pairs(NamedTuple):
    """The scores of both kinds at some weights: counts at the nodes of a grid."""

    first: int
    good: np.ndarray
    bad: np.ndarray
    loss: float


def _kernel(of: Callable[[np.ndarray], np.ndarray], counts: np.ndarray, step: float) -> np.ndarray:
    """For each node the sum over ``counts`` of ``of`` (that node's score less the other's)."""
    n = len(counts)
    apart = np.arange(1 - n, n) * step
    size = 1 << (3 * n - 3).bit_length()
    both = np.fft.irfft(np.fft.rfft(of(apart), size) * np.fft.rfft(counts, size), size)
    return both[n - 1 : 2 * n - 1]


def _preferred(apart: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(apart, -500, 500)))


def _counted(blocks: DataFrame, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> _Pairs:
    def told(good: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        scores = _expanded(shapes, centre, spread) @ weights
        first = int(np.floor(scores.min() / GRID))
        n = int(np.floor(scores.max() / GRID)) - first + 2
        return np.concatenate([[first], *(_spread_over(scores[own], first, n) for own in (good, ~good))])

    made = _each_block(blocks, told)
    first = int(min(m[0] for m in made))
    n = int(max(m[0] + len(m) // 2 for m in made)) - first
    both = np.zeros((2, n))
    for m in made:
        at, own = int(m[0]) - first, m[1:].reshape(2, -1)
        both[:, at : at + own.shape[1]] += own
    good, bad = both / both.sum(axis=1, keepdims=True)
    loss = good @ _kernel(lambda d: np.logaddexp(0, -d), bad, GRID) + SHRINK / 2 * weights @ weights
    return _Pairs(first, good, bad, float(loss))


def _newton(
    blocks: DataFrame, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray, held: _Pairs, n_good: int, n_bad: int
) -> np.ndarray:
    """The step from the slope and the bend of the loss over all pairs."""
    n, first, width = len(held.good), held.first, len(weights)
    nodes = (first + np.arange(n)) * GRID
    # How often a text of some score is on the wrong side of its pairs.
    wrong = [_kernel(lambda d: _preferred(-d), held.bad, GRID), _kernel(_preferred, held.good, GRID)]
    # The bend at every so many nodes: the same nodes for both texts of a pair.
    every = -(-n // COARSE)
    low, wide = first // every, every * GRID
    m = (first + n - 1) // every - low + 2

    def bent(apart: np.ndarray) -> np.ndarray:
        return _preferred(apart) * _preferred(-apart)

    coarse = [np.clip(_kernel(bent, _spread_over(nodes, low, m, own[:, None], wide)[:, 0], wide), 0, None) for own in (held.bad, held.good)]
    known = (low + np.arange(m)) * wide

    def told(good: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        x = _expanded(shapes, centre, spread)
        scores, out = x @ weights, []
        for own, off, bend in zip((good, ~good), wrong, coarse, strict=True):
            mine, at = x[own], scores[own]
            out.append(np.interp(at, nodes, off) @ mine)
            out.append(((mine * np.interp(at, known, bend)[:, None]).T @ mine).ravel())
            out.append(_spread_over(at, low, m, mine, wide).ravel())
        return np.concatenate(out)

    sums = np.sum(_each_block(blocks, told), axis=0).reshape(2, -1)
    sums = sums / np.array([[n_good], [n_bad]])
    slope, bend, parts = -sums[0, :width] + sums[1, :width] + SHRINK * weights, SHRINK * np.eye(width), []
    for own in sums:
        bend += own[width : width + width * width].reshape(width, width)
        parts.append(own[width + width * width :].reshape(m, width))
    across = np.arange(m) * wide
    cross = parts[0].T @ bent(across[:, None] - across[None, :]) @ parts[1]
    return np.linalg.solve(bend - cross - cross.T, slope)


def _quantile(scores: DataFrame, share: float, n: int) -> float:
    """The middle of the two scores around a share of all, found by counting ever smaller ranges."""
    place = share * (n - 1)
    lower, upper = int(np.floor(place)), int(np.ceil(place))
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    below, equal = 0, n  # rows below the range that holds the lower score, and in it
    while low < high:
        at = F.least(F.floor((F.col("score") - low) / (high - low) * BINS), F.lit(BINS - 1))
        inside = scores.where(F.col("score").between(low, high)).groupBy(at.alias("bin"))
        bins = inside.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
        for own in sorted(bins, key=lambda r: r.bin):
            if below + own.n > lower:
                low, high, equal = own.low, own.high, own.n
                break
            below += own.n
    if upper < below + equal:
        return low
    return (low + scores.where(F.col("score") > low).agg(F.min("score")).first()[0]) / 2


def _fit(learnt: DataFrame) -> Model:
    """From all of ``learnt`` (doc_id, label, shape)."""
    counts = {int(r["label"]): r["n"] for r in learnt.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_good, n_bad = counts.get(1, 0), counts.get(0, 0)
    n, width = n_good + n_bad, 3 * WIDTH
    if not n_good or not n_bad:
        # Nothing to prefer: every text scores the same, on the side that is labelled.
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(width), 1.0 if n_bad else -1.0)
    number = F.pmod(F.xxhash64("doc_id"), F.lit(min(BLOCKS, -(-n // BLOCK)))).cast("int")
    blocks = stored(learnt.withColumn("block", number).groupBy("block").applyInArrow(_packed, "block int, labels binary, shapes binary"), "shape-blocks")
    centre = np.sum(_each_block(blocks, lambda _, x: x.sum(axis=0)), axis=0) / n
    spread = np.sqrt(np.sum(_each_block(blocks, lambda _, x: ((x - centre) ** 2).sum(axis=0)), axis=0) / n) + 1e-9
    weights = np.zeros(width)
    held = _counted(blocks, centre, spread, weights)
    for _ in range(ROUNDS):
        step = _newton(blocks, centre, spread, weights, held, n_good, n_bad)
        after = _counted(blocks, centre, spread, weights - step)
        while after.loss > held.loss + CLOSE and np.abs(step).max() > CLOSE:
            step = step / 2
            after = _counted(blocks, centre, spread, weights - step)
        weights, held = weights - step, after
        if np.abs(step).max() <= CLOSE * (1 + np.abs(weights).max()):
            break
    final = Model(centre, spread, weights, 0.0)

    @F.arrow_udf("double")
    def valued(shapes: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(shapes.to_pylist()), "<f8").reshape(-1, WIDTH)
        return pa.array(_expanded(rows, final.centre, final.spread) @ final.weights)

    scores = stored(learnt.select(valued("shape").alias("score")), "learnt-scores")
    return final._replace(cut=float(_quantile(scores, n_bad / n, n)))


def _packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One row of a block's labels and shapes, in the order of ids."""
    rows = rows.sort_by("doc_id")
    labels = np.array(rows["label"].to_pylist(), "i1").tobytes()
    shapes = b"".join(rows["shape"].to_pylist())
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "labels": pa.array([labels], pa.binary()), "shapes": pa.array([shapes], pa.binary())})


def fit(
    docs: DataFrame, labels: DataFrame, learns: Column | None = None,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> Model:
    """Learns from all labelled texts for whose label ``learns`` holds (a condition on
    labels.doc_id); the driver holds sums over them. Ids labelled both ways, null ids and null
    labels are left out; of rows that share an id the text of the least digest is taken.
    Without labels of both kinds every text gets one score, on the labelled side, or good when
    there is no label at all."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    known = labelled.known(known, "label", F.lit(True) if learns is None else learns)

    @F.arrow_udf("binary")
    def shaped(texts: pa.Array) -> pa.Array:
        return pa.array([row.astype("<f8").tobytes() for row in _shapes(texts)], pa.binary())

    # Shapes are made before the join, so that no text is shuffled.
    shapes = docs.where("doc_id is not null").select("doc_id", F.struct(F.xxhash64("text"), shaped("text").alias("shape")).alias("own"))
    learnt = shapes.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("own").alias("own"))
    return _fit(stored(learnt.select("doc_id", "label", "own.shape"), "shapes"))


def score(text: Column | str, model: Model) -> Column:
    """A text's quality, 0 to 1; 0.5 at the cut. A null or empty text is scored by the
    form of an empty one."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        x = _expanded(_shapes(texts), model.centre, model.spread)
        return pa.array(1 / (1 + np.exp(-np.clip(x @ model.weights - model.cut, -30, 30))))

    return scored(text)


def drop_poor(docs: DataFrame, labels: DataFrame, learns: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores 0.5 or more; all columns stay, each repeated
    row and each row without an id is judged by its own text."""
    return docs.where(score(text, fit(docs, labels, learns, doc_id=doc_id, text=text)) >= 0.5)
