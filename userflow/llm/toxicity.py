"""Counterfactual-regularised toxicity classifier.

A logistic model over hashed words and word beginnings, with an L1 penalty that leaves
few of them. For each learning text a counterfactual is made by swapping all its identity
terms for other ones (in a text that names none, by naming one), and the squared change
of the score is penalised, so that naming a group does not by itself make a text toxic.

All labelled texts are learnt from. Their features are stored once. The model grows by the
features along which the loss over all of them falls most steeply, until none is left that the
penalty would let in; Spark adds up slopes and bends, and the driver holds those of the features
in the model.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm import labelled, words
from userflow.llm.tables import stored

SAMPLE_BYTES = 64 << 20  # of the texts to learn from, where their number is bounded
BITS = 20  # of a feature's number
LEAST_TEXTS = 4  # that a feature must occur in to be learnt
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # bytes of a word's beginning that make a feature
SPARSITY = 1e-3
FAIRNESS = 1.0  # weight of the counterfactual penalty
STRONGEST = 128  # features that the model grows by at once
RARE = 0.1  # share of the weight that a class has at least
LET_IN = 1.01  # times SPARSITY, the slope from which a feature is let in
NEWTON = 50  # steps, at most
CLOSE = 1e-4  # change of a weight at which they end
ROUNDS = 200  # steps without SPARSITY
FINE = 1 << 20  # a text's share of a slope is counted in such parts, so that sums are exact
BLOCK = 8192  # labelled texts of a block, until there are so many blocks
BLOCKS = 64
PARTS = ("labels", "counts", "sizes", "own")  # of a block
HELD = 32 << 20  # bytes of all blocks, up to which the driver holds them
CHUNK = 1024  # texts whose weights' products are made at once

# Neutral names of groups, swapped for each other.
IDENTITY_TERMS = (
    "women", "men", "muslims", "christians", "jews", "hindus", "atheists", "immigrants",
    "gay", "lesbian", "straight", "transgender", "black", "white", "asian", "latino",
    "mujeres", "hombres", "musulmanes", "cristianos", "inmigrantes",
    "femmes", "hommes", "musulmans", "juifs", "immigrés",
    "frauen", "männer", "muslime", "christen", "juden", "einwanderer",
)


class Model(NamedTuple):
    bias: float
    features: np.ndarray  # numbers of the features with a weight, ascending
    weights: np.ndarray


def _features(part: words.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Text index and feature number of every word and word beginning, with repeats."""
    starts, ends, at = words.placed(part, words.ALNUM)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    hasher, texts, numbers = words.Hasher(part), [], []
    for size in (*BEGINNINGS, 0):
        held = ends - starts > size if size else np.ones(len(starts), bool)
        begin = starts[held]
        hashes = hasher.of(begin, begin + size if size else ends[held], size)
        texts.append(text[held])
        numbers.append((hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(numbers)


def _distinct(text: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((text << BITS) | number)
    return both >> BITS, both & ((1 << BITS) - 1)


def _feature_lists(texts: pa.Array) -> pa.Array:
    out = []
    for part in words.slices(texts):
        text, number = _distinct(*_features(part))
        cuts = np.searchsorted(text, np.arange(len(part.offsets)))
        out += [number[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.array(out, pa.binary())


def _term_features() -> list[np.ndarray]:
    return [np.frombuffer(x, "<i4") for x in _feature_lists(pa.array(IDENTITY_TERMS)).to_pylist()]


def _counterfactuals(numbers: list[np.ndarray], turns: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, feature, +1 or -1): what swapping its terms changes in a text. Which
    ones are put in their place goes by the text's turn, or else its row."""
    terms = _term_features()
    words_only = [set(t) for t in terms]
    rows, features, signs = [], [], []
    for i, own in enumerate(numbers):
        held = set(own.tolist())
        named = [k for k, t in enumerate(words_only) if t <= held]
        # Term k becomes the term so many places on; a text without one gets one.
        ahead = 1 + (7 * (turns[i] if turns else i) + 3) % (len(terms) - 1)
        new = [(k + ahead) % len(terms) for k in named] or [ahead]
        old = set().union(*(words_only[k] for k in named))
        fresh = set().union(*(words_only[k] for k in new))
        gone, come = old - fresh, fresh - held
        rows += [i] * (len(gone) + len(come))
        features += [*gone, *come]
        signs += [-1.0] * len(gone) + [1.0] * len(come)
    return np.array(rows, np.int64), np.array(features, np.int64), np.array(signs)


def _logit(share: float) -> float:
    return float(np.log(share / (1 - share)))


def _packed(number: np.ndarray) -> bytes:
    """Ascending numbers as 16-bit differences, 0 for 65535 more."""
    apart = np.diff(number, prepend=-1)
    far = (apart - 1) // 65535
    ends = np.cumsum(far + 1)
    out = np.zeros(ends[-1] if len(ends) else 0, "<u2")
    out[ends - 1] = apart - 65535 * far
    return out.tobytes()


def _unpacked(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of everything in packed lists."""
    lists = lists.to_pylist()
    sizes = np.array([len(x) // 2 for x in lists], np.int64)
    apart = np.frombuffer(b"".join(lists), "<u2")
    row = np.repeat(np.arange(len(lists)), sizes)
    sums = np.concatenate([[0], np.cumsum(np.where(apart == 0, 65535, apart).astype(np.int64))])
    number = sums[1:] - sums[(np.cumsum(sizes) - sizes)[row]] - 1
    return row[apart != 0], number[apart != 0]


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _slopes(learnt: DataFrame, bias: float, features: np.ndarray, weights: np.ndarray) -> DataFrame:
    """For each feature, the labelled texts that hold it and their slope in FINE parts, of
    each class."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, held, slope = np.zeros(1 << BITS), np.zeros((2, 1 << BITS)), np.zeros((2, 1 << BITS))
        weight[features] = weights
        for batch in batches:
            row, number = _unpacked(batch["features"])
            toxic = np.array(batch["label"].to_pylist(), np.int64)
            z = bias + np.bincount(row, weight[number], len(toxic))
            error = np.round((_chance(z) - toxic) * FINE)
            for c in (0, 1):
                own = toxic[row] == c
                held[c] += np.bincount(number[own], minlength=1 << BITS)
                slope[c] += np.bincount(number[own], error[row[own]], 1 << BITS)
        there = np.flatnonzero(held.any(axis=0))
        columns = [there.astype(np.int32), *(x[c, there].astype(np.int64) for x in (held, slope) for c in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["feature", "h0", "h1", "s0", "s1"])

    sums = learnt.select("label", "features").mapInArrow(summed, "feature int, h0 long, h1 long, s0 long, s1 long")
    return sums.groupBy("feature").agg((F.sum("h0") + F.sum("h1")).alias("held"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1"))


def _swapped(learnt: DataFrame, each: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """The features of the identity terms, and how often swaps change two of them together."""
    own = np.unique(np.concatenate(_term_features()))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(own) * len(own)))
        for batch in batches:
            row, number = _unpacked(batch["features"])
            named = np.isin(number, own)
            row, number = row[named], number[named]
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            at, feature, sign = _counterfactuals([number[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], batch["turn"].to_pylist())
            toxic = np.array(batch["label"].to_pylist(), np.int64)
            change = np.zeros((batch.num_rows, len(own)))
            change[at, np.searchsorted(own, feature)] = sign
            for c in (0, 1):
                total[c] += (change[toxic == c].T @ change[toxic == c]).ravel()
        there = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(there), *(pa.array(t[there].astype(np.int64)) for t in total)], ["at", "n0", "n1"])

    sums = learnt.select("label", "turn", "features").mapInArrow(summed, "at long, n0 long, n1 long")
    found = sums.groupBy("at").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    both = np.zeros(len(own) ** 2)
    both[found["at"].to_numpy()] = each[0] * found["n0"].to_numpy() + each[1] * found["n1"].to_numpy()
    return own, both.reshape(len(own), -1)


def _collapsed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A block in one row: its texts by label and features, and how often each occurs."""
    counts = sorted(Counter(zip(rows["label"].to_pylist(), rows["own"].to_pylist(), strict=True)).items())
    parts = [
        np.array([label for (label, _), _ in counts], "<i8").tobytes(),
        np.array([n for _, n in counts], "<i8").tobytes(),
        np.array([len(own) // 4 for (_, own), _ in counts], "<i8").tobytes(),
        b"".join(own for (_, own), _ in counts),
    ]
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), **{c: pa.array([p], pa.binary()) for c, p in zip(PARTS, parts, strict=True)}})


def _blocks(learnt: DataFrame, n: int, features: np.ndarray) -> DataFrame:
    """The texts with the places of those of their features that are among ``features``."""

    @F.arrow_udf("binary")
    def among(lists: pa.Array) -> pa.Array:
        place = np.full(1 << BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        row, number = _unpacked(lists)
        used = place[number] >= 0
        row, at = row[used], place[number[used]].astype("<i4")
        cuts = np.searchsorted(row, np.arange(len(lists) + 1))
        return pa.array([at[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())

    number = F.pmod(F.xxhash64("doc_id"), F.lit(min(BLOCKS, -(-n // BLOCK)))).cast("int")
    rows = learnt.select(number.alias("block"), F.col("label").cast("int").alias("label"), among("features").alias("own"))
    return stored(rows.groupBy("block").applyInArrow(_collapsed, "block int, labels binary, counts binary, sizes binary, own binary"), "toxicity-blocks")


class _Texts:
    """Learning texts in blocks. Where they are small they are held on the driver: the sums of
    blocks, and so the model, are the same."""

    def __init__(self, blocks: DataFrame, each: tuple[float, float]):
        self.blocks, self.each, self.held = blocks.select("block", *PARTS), np.array(each), None
        size = blocks.agg(F.sum(sum((F.octet_length(c) for c in PARTS), F.lit(0)))).first()[0]
        if size <= HELD:
            rows = self.blocks.toArrow().sort_by("block")
            self.held = list(zip(*(rows[c] for c in PARTS), strict=True))

    def sums(self, at: np.ndarray, bends: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
        """The loss of all texts, its slope and, if asked for, its bend, of the bias and the
        weights in ``at``."""
        width, each = len(at), self.each
        if self.held is not None:
            made = [_block_sums(row, at, each, bends) for row in self.held]
        else:

            @F.arrow_udf("binary")
            def summed(*columns: pa.Array) -> pa.Array:
                return pa.array([_block_sums(row, at, each, bends).tobytes() for row in zip(*columns, strict=True)], pa.binary())

            fetched = self.blocks.select("block", summed(*PARTS).alias("made")).toArrow().sort_by("block")
            made = [np.frombuffer(x.as_buffer(), "<f8") for x in fetched["made"]]
        total = np.sum(made, axis=0)
        return float(total[0]), total[1 : width + 1], total[width + 1 :].reshape(-1, width)


def _block_sums(row: tuple[pa.Scalar, ...], at: np.ndarray, each: np.ndarray, bends: bool) -> np.ndarray:
    width = len(at)
    toxic, n, size = (np.frombuffer(x.as_buffer(), "<i8") for x in row[:3])
    own, cuts = np.frombuffer(row[3].as_buffer(), "<i4"), np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(n)), size)
    z = at[0] + np.bincount(text, at[1:][own], len(n))
    weight, chance = n * each[toxic], _chance(z)
    error, bend = weight * (chance - toxic), weight * chance * (1 - chance)
    loss = (weight * np.logaddexp(0, np.where(toxic == 1, -z, z))).sum()
    out = [[loss, error.sum()], np.bincount(own, error[text], width - 1)]
    if bends:
        total = np.zeros((width, width))
        for a in range(0, len(n), CHUNK):
            b = min(a + CHUNK, len(n))
            x = np.zeros((b - a, width))
            x[:, 0] = 1
            x[text[cuts[a] : cuts[b]] - a, own[cuts[a] : cuts[b]] + 1] = 1
            total += (x * bend[a:b, None]).T @ x
        out.append(total.ravel())
    return np.concatenate(out)


def _step(slope: np.ndarray, bend: np.ndarray, at: np.ndarray, sparsity: float) -> np.ndarray:
    """Where the bent slope and the penalty on all but the first of ``at`` are least, as a
    change of it: one coordinate after the other."""
    change, ahead = np.zeros(len(at)), slope.copy()
    for _ in range(200):
        most = 0.0
        for j in np.flatnonzero(np.diag(bend) > 0):
            before = at[j] + change[j]
            after = before - ahead[j] / bend[j, j]
            if j:
                after = np.sign(after) * max(abs(after) - sparsity / bend[j, j], 0.0)
            if after != before:
                change[j] += after - before
                ahead += (after - before) * bend[j]
                most = max(most, abs(after - before))
        if most < CLOSE / 10:
            break
    return change


def _solved(texts: _Texts, at: np.ndarray, swaps: np.ndarray) -> np.ndarray:
    """The bias and weights, from ``at`` on, at which the loss with its penalties is least."""
    quadratic = np.zeros((len(at), len(at)))
    quadratic[1:, 1:] = swaps

    def valued(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, slope, bend = texts.sums(at, bends=True)
        whole = loss + at @ quadratic @ at / 2 + SPARSITY * np.abs(at[1:]).sum()
        return whole, slope + quadratic @ at, bend + quadratic

    held = valued(at)
    for _ in range(NEWTON):
        step = _step(held[1], held[2] + 1e-9 * np.eye(len(at)), at, SPARSITY)
        after = valued(at + step)
        while after[0] > held[0] + 1e-9 and np.abs(step).max() > CLOSE:
            step = step / 2
            after = valued(at + step)
        at, held = at + step, after
        if np.abs(step).max() <= CLOSE:
            break
    return at


def _freed(texts: _Texts, bias: float, swaps: np.ndarray) -> np.ndarray:
    """So many steps without SPARSITY, scaled per feature, from no weights on: as many steps
    for all features keep one that tells all from taking the others' part."""
    weight, seen = np.zeros(len(swaps)), np.zeros(len(swaps))
    for _ in range(ROUNDS):
        _, slope, _ = texts.sums(np.concatenate([[bias], weight]))
        down = slope[1:] + swaps @ weight
        seen += down * down
        weight = weight - 0.3 / np.sqrt(seen + 1e-10) * down
        bias -= 2 * slope[0]
    return np.concatenate([[bias], weight])


def _fit(learnt: DataFrame, fairness: float, share: float | None) -> Model:
    """From all of ``learnt`` (doc_id, label, turn, features). A class weighs by its texts, a rare
    one RARE in all; the bias is then set to ``share`` of ones, or else what they are."""
    counts = {int(r["label"]): r["n"] for r in learnt.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    n = clean + toxic
    if not clean or not toxic:
        return Model(_logit((toxic + 0.5) / (n + 2)), np.empty(0, np.int64), np.empty(0))
    ones = min(max(toxic / n, RARE), 1 - RARE)
    each = ((1 - ones) / clean, ones / toxic)
    terms, swaps = _swapped(learnt, each)
    swaps = fairness * swaps

    def of(features: np.ndarray) -> np.ndarray:
        """The part of ``swaps`` that is about these features."""
        out, named = np.zeros((len(features), len(features))), np.flatnonzero(np.isin(features, terms))
        at = np.searchsorted(terms, features[named])
        out[np.ix_(named, named)] = swaps[np.ix_(at, at)]
        return out

    at, features = np.array([_logit(ones)]), np.empty(0, np.int64)
    while True:
        slope = (each[0] * F.col("s0") + each[1] * F.col("s1")) / FINE
        steep = _slopes(learnt, float(at[0]), features, at[1:]).withColumn("slope", slope)
        steep = steep.where(F.col("feature").isin(terms.tolist()) | ((F.col("held") >= min(LEAST_TEXTS, n)) & (F.abs("slope") > LET_IN * SPARSITY)))
        most = STRONGEST + len(features) + len(terms)
        found = steep.orderBy(F.abs("slope").desc(), "feature").limit(most).toArrow()
        number, slopes = found["feature"].to_numpy().astype(np.int64), found["slope"].to_numpy().copy()
        named, held = np.isin(number, terms), np.isin(features, terms)
        mine = np.searchsorted(terms, features[held])
        slopes[named] += swaps[np.ix_(np.searchsorted(terms, number[named]), mine)] @ at[1:][held]
        fresh = ~np.isin(number, features) & (np.abs(slopes) > LET_IN * SPARSITY)
        number, slopes = number[fresh], np.abs(slopes[fresh])
        if not len(number):
            break
        number = number[np.lexsort((number, -slopes))[:STRONGEST]]
        kept = at[1:] != 0
        weight = dict(zip(features[kept].tolist(), at[1:][kept].tolist(), strict=True)) | dict.fromkeys(number.tolist(), 0.0)
        features = np.array(sorted(weight), np.int64)
        at = np.array([at[0], *(weight[f] for f in features.tolist())])
        at = _solved(_Texts(_blocks(learnt, n, features), each), at, of(features))
    # Then the features that the penalty leaves without it: it would keep scores too close to
    # the base rate.
    features = features[at[1:] != 0]
    at = _freed(_Texts(_blocks(learnt, n, features), each), _logit(ones), of(features))
    return Model(float(at[0]) + _logit(toxic / n if share is None else share) - _logit(ones), features, at[1:])


# The words of a text, each once: they have all its features.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _bag(text: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.split(F.translate(text, _UPPER, _LOWER), _NO_WORD))), " ")


def fit(
    docs: DataFrame, labels: DataFrame, learns: Column | None = None, rows: int | None = None, fairness: float = FAIRNESS,
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """Learns from all labelled texts for whose label ``learns`` holds (a condition on
    labels.doc_id), those of a rare class with the weight of RARE in all; the bias is then set
    to the share of all labels. The driver holds sums for the features of the model. With ``rows``
    it learns from so many at most, half of them toxic where there are enough, and SAMPLE_BYTES
    of text, the longest left out first. Ids labelled both ways, null ids and null labels are left out;
    of rows that share an id one is taken. Without labels of both kinds the model knows no
    feature and gives every text one score, on the labelled side, or not toxic when there is no
    label at all."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    learns, share = F.lit(True) if learns is None else learns, None
    if rows is None:
        # Of a text only its words are shuffled.
        bags = docs.where("doc_id is not null").select("doc_id", _bag(F.col("text")).alias("bag"))
        taken = bags.join(labelled.known(known, "label", learns), "doc_id").groupBy("doc_id", "label").agg(F.min("bag").alias("bag"))
    else:
        taken, share = labelled.sample_by_class(docs, known, "label", learns, rows)
        taken = labelled.within(taken, SAMPLE_BYTES).withColumnRenamed("text", "bag")

    @F.arrow_udf("binary")
    def listed(texts: pa.Array) -> pa.Array:
        return pa.array([_packed(np.frombuffer(x, "<i4")) for x in _feature_lists(texts).to_pylist()], pa.binary())

    turn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 16)).alias("turn")
    return _fit(stored(taken.select("doc_id", "label", turn, listed("bag").alias("features")), "toxicity-features"), fairness, share)


def _scores(texts: pa.Array, model: Model) -> pa.Array:
    weight = np.zeros(1 << BITS)
    weight[model.features] = model.weights
    out = [np.empty(0)]
    for part in words.slices(texts):
        text, number = _features(part)
        used = weight[number] != 0
        text, number = _distinct(text[used], number[used])
        z = model.bias + np.bincount(text, weight[number], len(part.offsets) - 1)
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return pa.array(np.concatenate(out))


def score(text: Column | str, model: Model) -> Column:
    """How likely a text is toxic, 0 to 1; a null or empty text gets the base rate."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return _scores(texts, model)

    return scored(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, learns: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5; all columns stay, each repeated
    row and each row without an id is judged by its own text."""
    return docs.where(score(text, fit(docs, labels, learns, doc_id=doc_id, text=text)) < 0.5)
