"""Near-duplicate texts: banded MinHash candidates, odd sketches, links on full sets.

A text's set holds its distinct word shingles. Texts with equal sets form a class; one
member stands for it. Each class gets MinHash samples. The first of them make band keys,
and classes that share a key are candidates. All of them are folded into an odd sketch:
sample i flips one bit of a small bitmap, so that equal samples cancel in the XOR of two
bitmaps and its population count tells how many samples differ, most precisely at high
similarity. A second bitmap holds the parity of the whole set; its count is never more
than the shingles by which two sets differ, so that what it refutes is refuted for sure.
Candidates whose counts are too high for the threshold go without a look at their sets;
the others are decided on their full sets.

No pair list grows with the square of a bucket. First every class is compared with one
hub of each of its buckets. Links found so join classes. Then only pairs of different
components are left: in each bucket the members outside its largest component are held
against the others. What a hub has already joined is never compared again, and no link
between components is skipped.

A bucket may be full of look-alikes below the threshold, say of one template, so that many
are outside. Buckets with more than WIDE of them are split further, by their members' full
sets: ordered from the rarest shingle to the commonest, two sets that meet the threshold
share one of their first shingles (prefix filter), and a template's common ones are last. At
the first that they share, enough shingles must be left in both (positional filter).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm import bloom, graph, words
from userflow.llm.tables import free, stored

ROWS = 4  # samples that make one band key
SAMPLES = 192  # samples folded into a sketch
SKETCH_WORDS = 4  # 64-bit words of a sketch
PARITY_WORDS = 16  # 64-bit words of the whole set's parity
WIDE = 1  # members outside its largest component that a bucket may have before it is split
COUNTERS = 1 << 20  # of shingles, by hash: tell common ones from rare ones
MISS = 1e-7  # chance that a pair at the threshold shares no band, and that its sketches refute it


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that leave a pair at the threshold without a shared key at most that often."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows))))


def flips_beyond(percent: int, samples: int) -> np.ndarray:
    """For each population count the chance that a pair at the threshold shows more: each
    sample differs by itself and then flips two bits, of which those flipped an odd number
    of times count."""
    bits, j = 64 * SKETCH_WORDS, percent / 100
    count = np.arange(bits + 1)
    odd = (count == 0).astype(float)  # the chance of each count after so many flips
    total = np.zeros(bits + 1)
    for differing in range(samples + 1):
        total += math.comb(samples, differing) * (1 - j) ** differing * j ** (samples - differing) * odd
        for _ in range(2):
            up, down = odd * (bits - count) / bits, odd * count / bits
            odd = np.concatenate([[0.0], up[:-1]]) + np.concatenate([down[1:], [0.0]])
    return np.concatenate([np.cumsum(total[::-1])[::-1][1:], [0.0]])


def most_flips(percent: int, samples: int, miss: float = MISS) -> int:
    """The largest population count that a pair at the threshold shows but that often."""
    return int(np.argmax(flips_beyond(percent, samples) <= miss))


def _signed(found: words.Words, bands: int, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and sketches of the texts; none may be without words."""
    rows = len(found.bounds) - 1
    keys = np.empty((rows, bands), np.uint64)
    sketch = np.zeros((rows, SKETCH_WORDS), np.uint64)
    at, factors = np.arange(rows), words.seeds(samples, 11)
    for i, factor in enumerate(factors):
        least = np.minimum.reduceat(found.hashes * factor, found.bounds[:-1]) if rows else np.empty(0, np.uint64)
        bit = words.mix(least ^ factor) >> np.uint64(56)
        sketch[at, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
        band, row = divmod(i, ROWS)
        if band < bands:
            keys[:, band] = words.mix((keys[:, band] if row else np.uint64(band)) ^ (least * factors[band]))
    return keys, sketch


def _parities(found: words.Words) -> np.ndarray:
    """Of each text's set: a bit per shingle, flipped by its hash."""
    rows, bits = len(found.bounds) - 1, 64 * PARITY_WORDS
    text = np.repeat(np.arange(rows), np.diff(found.bounds))
    place = (words.mix(found.hashes) >> np.uint64(54)).astype(np.int64)
    odd = (np.bincount(text * bits + place, minlength=rows * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def _marks(found: words.Words) -> pa.Array:
    """A digest of each set; null for the empty one."""
    ends = zip(found.bounds[:-1], found.bounds[1:], strict=True)
    return pa.array([hashlib.blake2b(found.hashes[a:b], digest_size=16).digest() if a < b else None for a, b in ends], pa.binary())


def _signatures(shingle: int, bands: int, samples: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1)):
                found = words.distinct(words.windows(words.words(part), shingle))
                sizes = np.diff(found.bounds)
                full = np.flatnonzero(sizes)
                kept = words.Words(found.hashes, np.concatenate([[0], found.bounds[1:][full]]))
                keys, sketch = _signed(kept, bands, samples)
                width = np.zeros(len(sizes) + 1, np.int64)
                width[1:] = np.cumsum(sizes > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        _marks(found),
                        words.lists(keys.reshape(-1), width * bands),
                        words.lists(sketch.reshape(-1), width * SKETCH_WORDS),
                        words.lists(_parities(kept), width * PARITY_WORDS),
                    ],
                    ["doc_id", "n_shingles", "mark", "bands", "sketch", "parity"],
                )

    return run


def signatures(docs: DataFrame, shingle: int, bands: int, samples: int) -> DataFrame:
    """Per text of docs (doc_id, text): n_shingles, mark (equal for equal sets, null for
    the empty one), bands (band keys), sketch (odd sketch of the samples) and parity."""
    schema = "doc_id long, n_shingles long, mark binary, bands array<long>, sketch array<long>, parity array<long>"
    return docs.mapInArrow(_signatures(shingle, bands, samples), schema)


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1)):
                found = words.distinct(words.windows(words.words(part), shingle))
                ids = batch.column(0).slice(part.first, len(found.bounds) - 1)
                yield pa.RecordBatch.from_arrays([ids, _marks(found), words.lists(*found)], ["doc_id", "mark", "items"])

    return run


def _marked(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch.column(1)):
                found = words.distinct(words.windows(words.words(part), shingle))
                n = len(found.bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), batch.column(2).slice(part.first, n), _marks(found)], ["doc_id", "key", "mark"]
                )

    return run


def sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, items): the full sets of the classes ``nodes`` (written). Only texts of their
    documents are read again; one text stands for a class."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", F.col("doc").alias("own"), F.col("mark").alias("set"))
    wanted = stored(wanted, "wanted")
    n = wanted.count()
    # Most texts are not wanted: a filter of bounded size keeps them out of the shuffle.
    few = bloom.build(wanted, "own", bloom.bits_for(n, 16, bloom.MOST_BITS), 2)
    read = docs.where(few.contains(F.col("doc_id"))).mapInArrow(_sets(shingle), "doc_id long, mark binary, items array<long>")
    same = (F.col("doc_id") == F.col("own")) & (F.col("mark") == F.col("set"))
    items = stored(read.join(wanted, same).select("node", "items"), "sets")
    if items.count() > n:  # repeated rows
        items = stored(items.dropDuplicates(["node"]), "sets")
    return items


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets meet the threshold. One side of a pair
    carries its set to the other."""
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "ids")
    items = sets_of(nodes, classes, docs, shingle)
    left = items.select(F.col("node").alias("a"), F.col("items").alias("left"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    linked = 100 * shared >= percent * (F.size("left") + F.size("right") - shared)
    return pairs.join(left, "a").join(right, "b").where(linked).select("a", "b")


def _apart(x: str, y: str, size: int):
    """In how many bits two bitmaps differ."""
    counts = [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(size)]
    return sum(counts[1:], counts[0])


def _plausible(flips: int, percent: int):
    """Whether texts x and y may be linked: few flips of the samples, and no more than
    the threshold allows of the sets. d shingles apart, n of both sets, and a similarity
    of (n - d) / (n + d)."""
    sets_apart = _apart("x.parity", "y.parity", PARITY_WORDS)
    both = F.col("x.n_shingles") + F.col("y.n_shingles")
    return (_apart("x.sketch", "y.sketch", SKETCH_WORDS) <= flips) & (
        (100 + percent) * sets_apart <= (100 - percent) * both
    )


def mains(placed: DataFrame) -> DataFrame:
    """Of each bucket of ``placed`` (key, node, component) with several components: main, its
    largest one, and outside, how many members are in others."""
    held = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = held.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("parts"))
    return largest.where("parts > 1").select("key", F.col("top.component").alias("main"), (F.col("n") - F.col("top.n")).alias("outside"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of a task's sets fall to each counter."""
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        values = batch.column(0).flatten().to_numpy().view(np.uint64)
        counts += np.bincount((values & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
    slot = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], ["slot", "n"])


def _prefixes(counts: np.ndarray, percent: int):
    """Of each set the first shingles in a common order, rarest first, with their places: as
    many as must hold one that a set at the threshold shares. One that no other set has needs
    no bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            seen = counts[(values & np.uint64(COUNTERS - 1)).astype(np.int64)]
            rows, places, tokens = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for i in range(len(lists)):
                own, often = values[bounds[i] : bounds[i + 1]], seen[bounds[i] : bounds[i + 1]]
                n = len(own)
                first = np.lexsort((own, often))[: n - -(-percent * n // 100) + 1]
                place = np.flatnonzero(often[first] > 1)
                rows.append(np.full(len(place), i))
                places.append(place)
                tokens.append(own[first[place]])
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(places))],
                ["key", "node", "component", "place"],
            )

    return run


def split_by_prefix(members: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Buckets (key, node, component, place) of ``members`` (node, component): by the shingles
    of their prefixes. Two members that meet the threshold share one."""
    items = sets_of(members.select("node"), classes, docs, shingle)
    placed = stored(items.join(members, "node").select("node", "component", "items"), "wide-sets")
    counted = placed.select("items").mapInArrow(_counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counted = counted.toArrow()  # COUNTERS rows at most
    counts = np.zeros(COUNTERS, np.int64)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    return placed.mapInArrow(_prefixes(counts, percent), "key long, node long, component long, place long")


def _across(placed: DataFrame, mixed: DataFrame, forms: DataFrame, plausible: Column) -> DataFrame:
    """Pairs (a, b) of members x, y of one bucket and different components, those outside its
    main component against the others, that are plausible. ``forms`` are joined by node."""
    held = placed.join(mixed.select("key", "main"), "key").join(forms, "node")
    held = stored(held, "mixed-members")
    x, y = held.where("component <> main").alias("x"), held.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    apart = F.col("x.component") != F.col("y.component")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & once & plausible)
    low, high = F.least("x.node", "y.node"), F.greatest("x.node", "y.node")
    return pairs.select(low.alias("a"), high.alias("b"))


class Linked(NamedTuple):
    """rows: doc_id, n_shingles, mark of each row; classes: mark, node (a number), doc (the
    smallest id), of the texts with equal sets; links: pairs (a, b) of nodes, enough to
    connect all that are connected."""

    rows: DataFrame
    classes: DataFrame
    links: DataFrame


def linked(docs: DataFrame, shingle: int, percent: int, samples: int) -> Linked:
    """The classes of ``docs`` (doc_id, text), and their links."""
    bands = bands_for(percent)
    samples = max(samples, bands * ROWS)
    signed = signatures(docs, shingle, bands, samples).withColumn("row", F.monotonically_increasing_id())
    rows = stored(signed, "signatures")
    # Equal sets have equal bands and sketches, so that copies collapse before the shuffle.
    classes = stored(
        rows.where("mark is not null and doc_id is not null")
        .groupBy("mark")
        .agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("doc"),
            F.first("bands").alias("bands"),
            F.struct(*(F.first(c).alias(c) for c in ("n_shingles", "sketch", "parity"))).alias("form"),
        ),
        "classes",
    )
    keyed = classes.select("node", F.explode("bands").alias("key"))
    # The hub order is the same for all buckets, so that most share few hubs.
    hub = F.min_by("node", F.xxhash64("node")).alias("hub")
    buckets = stored(
        keyed.groupBy("key").agg(hub, F.count("*").alias("n")).where("n > 1").drop("n"),
        "buckets",
    )
    members = stored(keyed.join(buckets, "key"), "members")
    plausible = _plausible(most_flips(percent, samples), percent)

    def of(side: str, name: str) -> DataFrame:
        return classes.select(F.col("node").alias(side), F.col("form").alias(name))

    stars = (
        members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        .join(of("a", "x"), "a").join(of("b", "y"), "b").where(plausible).select("a", "b").distinct()
    )
    links = stored(verified(stored(stars, "pairs"), classes, docs, shingle, percent), "links")
    joined = graph.components(links)

    placed = members.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    placed = stored(placed, "placed")
    mixed = stored(mains(placed), "mixed")
    # Of the buckets that two classes share, the one of the least key holds them together.
    here = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")
    form = classes.select("node", "bands", "form.*")
    rest = _across(placed, mixed.where(f"outside <= {WIDE}"), form, here & plausible)
    wide = mixed.where(f"outside > {WIDE}").select("key")
    if not wide.isEmpty():
        inside = stored(placed.join(wide, "key", "left_semi").select("node", "component").distinct(), "wide")
        split = stored(split_by_prefix(inside, classes, docs, shingle, percent), "prefixes")
        # At the first shingle that two sets share, as many must be left as they need in common.
        left = F.least(F.col("x.n_shingles") - F.col("x.place"), F.col("y.n_shingles") - F.col("y.place"))
        enough = (100 + percent) * left >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles"))
        rest = rest.union(_across(split, mains(split), form.drop("bands"), enough & plausible))
    rest = stored(rest.distinct(), "pairs")
    more = verified(rest, classes, docs, shingle, percent)
    every = stored(links.union(more), "links")
    return Linked(rows.select("doc_id", "n_shingles", "mark"), classes.select("mark", "node", "doc"), every)


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, percent: int = 80, samples: int = SAMPLES
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two texts are linked when 100 * shared >= percent * (all of both), over distinct
    shingles of ``shingle`` words; a text of fewer words is one shingle. component_id is
    the smallest doc_id reachable by links, kept tells whether it is the row's own.

    Null, empty and blank texts have no shingles and are linked with nothing. Repeated
    rows and rows of one id with several texts are one node, linked to what any of the
    texts is linked to; each row is returned. A row without an id is linked with nothing
    and kept, its component_id is null. Other columns are not looked at. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, classes, links = linked(docs, shingle, percent, samples)
    nodes = stored(rows.join(classes, "mark", "left").select("doc_id", "n_shingles", "node", "doc"), "nodes")
    # An id of several texts ties their classes.
    spans = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    ties = spans.select("doc_id", "a").join(nodes, "doc_id").select("a", F.col("node").alias("b"))
    final = stored(graph.components(stored(links.union(ties), "links")), "components")
    smallest = final.join(classes, "node").groupBy("component").agg(F.min("doc").alias("smallest"))
    final = stored(final.join(smallest, "component").select("node", "smallest"), "smallest")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc", "doc_id"))
    return nodes.join(final, "node", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, percent: int = 80, samples: int = SAMPLES
) -> DataFrame:
    """The rows of ``docs`` that stand for their group; all columns stay.

    A row is judged by its own text: groups are of linked texts, and the text of the smallest
    id stays (of several with that id, the one of the smallest digest). Rows that share an id
    and hold unlike texts are so judged each. Of rows equal in id and text one stays; all rows
    without an id stay, and all unlike texts without shingles.
    """
    table = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, classes, links = linked(table, shingle, percent, samples)
    placed = stored(graph.components(links).join(classes, "node"), "placed")
    chosen = placed.groupBy("component").agg(F.min(F.struct("doc", "mark")).alias("stays"))
    # Of each class with links: the document and the set that stay.
    losing = stored(placed.join(chosen, "component").select("mark", "doc", "stays"), "chosen")
    # Of the others, the smallest id of the class.
    stays = stored(
        classes.join(losing.select("mark", "stays"), "mark", "left").select("mark", F.coalesce("stays", F.struct("doc", "mark")).alias("stays")), "stays"
    )
    known = rows.where("doc_id is not null")
    repeated = stored(known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    of_stay = (F.col("doc_id") == F.col("stays.doc")) & (F.col("mark") == F.col("stays.mark"))
    gone = known.join(stays, "mark").where(~of_stay).select("doc_id").distinct().join(repeated, "doc_id", "left_anti")
    left = bloom.without(docs, doc_id, stored(gone, "gone"))
    if repeated.isEmpty():
        return left
    again, key, chosen_key = free(docs, "again"), free(docs, "key"), free(docs, "chosen_key")
    repeated = repeated.withColumnRenamed("doc_id", again)
    same = F.col(doc_id).cast("long") == F.col(again)
    single = left.join(repeated, same, "left_anti")
    several = left.join(repeated, same, "left_semi").withColumn(key, F.coalesce(F.sha2(F.col(text), 256), F.lit("")))
    own = several.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(key).alias("key"))
    marked = own.dropDuplicates(["doc_id", "key"]).mapInArrow(_marked(shingle), "doc_id long, key string, mark binary")
    kept = marked.join(stays, "mark", "left").where(F.col("mark").isNull() | of_stay)
    # Texts with one set, spaced in different ways, are one.
    kept = kept.groupBy("doc_id", F.coalesce("mark", F.col("key").cast("binary"))).agg(F.min("key").alias("key"))
    kept = stored(kept.select(F.col("doc_id").alias(again), F.col("key").alias(chosen_key)), "kept")
    judged = several.dropDuplicates([doc_id, key]).join(kept, same & (F.col(key) == F.col(chosen_key)), "left_semi").drop(key)
    return single.unionByName(judged)
