"""Benchmark decontamination: test suffixes searched in suffix arrays of the training text.

Each task builds suffix arrays over shards of its own documents and binary-searches
every suffix of every benchmark item in them, word by word: after w words the range of
the array holds all places where the first w words of the suffix stand. After a window's
length the range gives the window's occurrences, and where it runs empty the longest
verbatim match. Only runs of benchmark words as long as the shortest window enter an
array, since no other place can match.

The benchmark's distinct texts are sent to the tasks in blocks of bounded size; the documents
are scanned once for each block. One block is the rule. Which items have a text stays in a
table, which is joined to what matched.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm import bloom, words
from userflow.llm.tables import empty, free, stored

WINDOW = 13
SHARE = 20  # a document is contaminated when one word in so many is hit
BLOCK_BYTES = 16 << 20  # benchmark text sent to the tasks at once
PAIRS = 1 << 20  # of a document and a text, gathered before repeats go
SHARD_WORDS = 1 << 20  # words of a suffix array, unless one document has more


class Block(NamedTuple):
    """Benchmark items as ranks of their words; 0 stands between items."""

    ids: list  # of each text
    vocabulary: np.ndarray  # word hashes, ascending; rank 1 is the first
    ranks: np.ndarray
    starts: np.ndarray  # of every suffix at least as long as its item's window
    lengths: np.ndarray  # to the item's end
    needs: np.ndarray  # the window's length
    items: np.ndarray  # index of its item
    offsets: np.ndarray  # words before it in the item


def block_of(ids: list, texts: list, window: int) -> Block | None:
    """None when no item has a word."""
    parts = list(words.slices(pa.array(texts, pa.large_string()), 1 << 62))
    found = words.words(parts[0], words.ALNUM) if parts else None
    if found is None or not len(found.hashes):
        return None
    vocabulary, ranks = np.unique(found.hashes, return_inverse=True)
    held = np.diff(found.bounds)
    item_of = np.repeat(np.arange(len(held)), held)
    placed = np.zeros(len(ranks) + len(held) + 1, np.int64)
    at = np.arange(len(ranks)) + item_of
    placed[at] = ranks + 1
    offset = np.arange(len(ranks)) - found.bounds[:-1][item_of]
    left = held[item_of] - offset
    need = np.minimum(window, held)[item_of]
    whole = left >= need
    return Block(ids, vocabulary, placed, at[whole], left[whole], need[whole], item_of[whole], offset[whole])


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` ordered by the ``depth`` or more numbers from there on."""
    n, known = len(text), 1
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)

    def ranked(key: np.ndarray) -> None:
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))

    if n:
        ranked(text)
    while n and known < depth and rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[:-known] += rank[known:] + 1
        order = np.argsort(key, kind="stable")
        ranked(key)
        known *= 2
    return order


def _bound(text: np.ndarray, order: np.ndarray, low, high, deep: int, wanted, after: bool) -> np.ndarray:
    """First place in order[low:high] whose word ``deep`` is not below (or beyond) the wanted."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        word = text[order[middle] + deep]
        right = word <= wanted[open_] if after else word < wanted[open_]
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
        open_ = open_[low[open_] < high[open_]]
    return low


def search(text: np.ndarray, order: np.ndarray, block: Block):
    """For every test suffix: the range of its window's occurrences in ``order`` (empty:
    none), its longest match in words and one place of it."""
    n = len(block.starts)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    longest, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alive, deep = np.arange(n if len(order) else 0), 0
    while len(alive):
        wanted = block.ranks[block.starts[alive] + deep]
        start = _bound(text, order, low[alive], high[alive], deep, wanted, False)
        stop = _bound(text, order, start, high[alive], deep, wanted, True)
        deep += 1
        on = start < stop
        alive, start, stop = alive[on], start[on], stop[on]
        low[alive], high[alive] = start, stop
        longest[alive], place[alive] = deep, order[start]
        ready = block.needs[alive] == deep
        first[alive[ready]], last[alive[ready]] = start[ready], stop[ready]
        alive = alive[block.lengths[alive] > deep]
    return first, last, longest, place


class Shard:
    """Runs of benchmark words out of whole documents, with their places."""

    def __init__(self, block: Block, depth: int):
        self.block, self.depth = block, depth
        self.shortest = int(block.needs.min())
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, found: words.Words, row: int) -> None:
        known = self.block.vocabulary
        rank = np.minimum(np.searchsorted(known, found.hashes), len(known) - 1)
        rank = np.where(known[rank] == found.hashes, rank + 1, 0)
        starts, ends = words.runs(rank > 0, found.bounds)
        long_ = ends - starts >= self.shortest
        starts, ends = starts[long_], ends[long_]
        if not len(starts):
            return
        sizes = ends - starts
        goes_to = np.concatenate([[0], np.cumsum(sizes + 1)])
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out = at + np.repeat(goes_to[:-1] - starts, sizes)
        text, rows, places = (np.zeros(goes_to[-1], np.int64) for _ in range(3))
        document = np.searchsorted(found.bounds, starts, "right") - 1
        text[out] = rank[at]
        rows[out] = row + np.repeat(document, sizes)
        places[out] = at - np.repeat(found.bounds[document], sizes)
        self.parts.append((text, rows, places))
        self.size += len(text)

    def searched(self):
        text, rows, places = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = suffix_array(text, self.depth)
        padded = np.concatenate([text, np.zeros(self.depth + 1, np.int64)])
        return text, rows, places, order, search(padded, order, self.block)


def _shards(block: Block, texts: pa.Array, on_words, on_shard) -> None:
    shard = Shard(block, int(block.lengths.max()))
    for part in words.slices(texts):
        found = words.words(part, words.ALNUM)
        on_words(part.first, np.diff(found.bounds))
        shard.add(found, part.first)
        if shard.size >= SHARD_WORDS:
            on_shard(*shard.searched())
    if shard.size:
        on_shard(*shard.searched())


SPAN = pa.struct([("first", pa.int64()), ("past", pa.int64())])


def _found(block: Block, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each text: its words, the spans hit, and the items whose windows occur."""
    n = len(texts)
    n_words = np.zeros(n, np.int64)
    spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pairs: list[np.ndarray] = []
    held = 0

    def add(some: np.ndarray) -> None:
        # Distinct as they grow: many windows join one document and one text.
        nonlocal held
        pairs.append(some)
        held += len(some)
        if held > PAIRS:
            pairs[:] = [np.unique(np.concatenate(pairs))]
            held = 0

    def count(row, held):
        n_words[row : row + len(held)] = held

    def match(text, rows, places, order, result):
        first, last, _, _ = result
        hits = np.flatnonzero(first < last)
        if not len(hits):
            return
        hits = hits[np.lexsort((first[hits], block.needs[hits]))]
        cover = np.zeros(len(text) + 1, np.int64)
        key = np.stack([block.needs[hits], first[hits]])
        new = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        for a, b in zip(new, [*new[1:], len(hits)], strict=True):
            at = order[first[hits[a]] : last[hits[a]]]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + block.needs[hits[a]], -1)
            touched = np.unique(rows[at])
            items = np.unique(block.items[hits[a:b]])
            add((touched[:, None] * len(block.ids) + items[None, :]).ravel())
        starts, ends = words.runs(np.cumsum(cover[:-1]) > 0, np.array([0, len(text)]))
        spans.append((rows[starts], places[starts], places[ends - 1] + 1))

    _shards(block, texts, count, match)
    row, a, b = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else (np.empty(0, np.int64),) * 3
    by_place = np.lexsort((a, row))
    row, a, b = row[by_place], a[by_place], b[by_place]
    pair = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    ids = [block.ids[i] for i in pair % len(block.ids)]
    rows_of = np.arange(n + 1)
    span = pa.StructArray.from_arrays([pa.array(a), pa.array(b)], fields=list(SPAN))
    named = pa.array(ids, pa.int64())
    return (
        pa.array(n_words),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(row, rows_of), pa.int32()), span),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(pair // len(block.ids), rows_of), pa.int32()), named),
    )


def _by_document(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _found(block, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *found], ["doc_id", "mark", "n_words", "spans", "texts"]
            )

    return run


def _by_suffix(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []

            def match(text, rows, places, order, result, out=out):
                _, _, longest, place = result
                for i in np.flatnonzero(longest >= block.needs):
                    at = place[i]
                    found = (block.offsets[i], longest[i], rows[at], places[at])
                    out.append((block.ids[block.items[i]], *map(int, found)))

            _shards(block, batch.column(1), lambda *_: None, match)
            ids = batch.column(0).to_pylist()
            columns = list(zip(*[(i, w, n, ids[r], p) for i, w, n, r, p in out], strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["text_id", "item_word", "length", "doc_id", "word"]
            )

    return run


class Benchmark(NamedTuple):
    """texts: text_id, text, block of the distinct texts; ids: text_id, item_id; n: blocks."""

    texts: DataFrame
    ids: DataFrame
    n: int
    window: int

    def blocks(self) -> Iterator[Block]:
        """One at a time; those without a word are left out."""
        for i in range(self.n):
            fetched = self.texts.where(F.col("block") == i).select("text_id", "text").collect()
            block = block_of([r[0] for r in fetched], [r[1] for r in fetched], self.window)
            if block is not None:
                yield block


def benchmark_of(items: DataFrame, window: int, block_bytes: int) -> Benchmark:
    """``items`` (item_id, text) in blocks. A block holds ``block_bytes`` of text and one text
    more at most: texts are dealt by the running sum of their sizes, a text of many items once."""
    key = F.sha2("text", 256).alias("key")
    known = items.where("text is not null").select("item_id", "text", key)
    distinct = known.select("key", "text").dropDuplicates(["key"])
    distinct = stored(distinct.withColumn("text_id", F.monotonically_increasing_id()), "benchmark-texts")
    size, part = F.octet_length("text").cast("long"), F.shiftright("text_id", 33)
    # Sizes add up within a partition, and partitions add up, a row for each.
    sized = distinct.select("text_id", "text", size.alias("size"), part.alias("part"))
    parts = sized.groupBy("part").agg(F.sum("size").alias("whole"))
    before = F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("text_id"))
    block = F.floor((F.col("before") + F.col("running") - F.col("size")) / block_bytes)
    texts = sized.withColumn("running", running).join(parts, "part").select("text_id", "text", block.alias("block"))
    texts = stored(texts, "benchmark-blocks")
    ids = stored(known.select("item_id", "key").distinct().join(distinct.select("key", "text_id"), "key").select("text_id", "item_id"), "benchmark-ids")
    last = texts.agg(F.max("block")).first()[0]
    return Benchmark(texts, ids, 0 if last is None else last + 1, window)


def _columns(docs, benchmark, doc_id, text, item_id, item_text):
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs, benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (disjoint, first word and the word past
    the last) of words inside an occurrence of a window, items (item_ids, distinct) whose
    windows occur.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII,
    A-Z as a-z. A window is ``window`` consecutive words of an item; an item of fewer is
    one window, one without words is none. Null and empty texts have no words. An item
    without an id marks words and is not listed; items of one id count once. Repeated
    rows are each returned. Other columns are not looked at. The driver and the tasks hold one
    block, ``block_bytes`` of text and one text more at most.
    """
    docs, items = _columns(docs, benchmark, doc_id, text, item_id, item_text)
    known = benchmark_of(items, window, block_bytes)
    mark = F.sha2("text", 256) if known.n > 1 else F.lit(None).cast("string")
    marked = docs.withColumn("mark", mark)
    rows, hits = None, []
    for block in known.blocks():
        scan = marked.mapInArrow(_by_document(block), FOUND)
        if rows is None:
            rows = stored(scan, "matches")
            hits.append(rows.where("size(spans) > 0").dropDuplicates(["mark"]))
        else:  # one row of each text: rows of one text match alike
            hits.append(stored(scan.where("size(spans) > 0").dropDuplicates(["mark"]), "matches"))
    no_items = F.array().cast("array<bigint>")
    if rows is None:
        rows = marked.mapInArrow(_by_document(block_of([None], ["none"], window)), FOUND)
        return rows.select("doc_id", "n_words", F.expr("filter(spans, x -> false)").alias("spans"), no_items.alias("items"))
    if len(hits) > 1:
        put = _merged(_together(hits)).withColumnsRenamed({"mark": "own", "spans": "own_spans", "texts": "own_texts"})
        joined = rows.select("doc_id", "mark", "n_words").join(put.select("own", "own_spans", "own_texts"), F.col("mark") == F.col("own"), "left")
        none = rows.schema
        rows = joined.select(
            "doc_id", "mark", "n_words", *(F.coalesce(f"own_{c}", F.array().cast(none[c].dataType)).alias(c) for c in ("spans", "texts"))
        )
    # Few lists of texts recur; each is turned into ids once.
    lists = rows.where("size(texts) > 0").select("texts").distinct().withColumnRenamed("texts", "matched")
    named = lists.select("matched", F.explode("matched").alias("text_id")).join(known.ids.where("item_id is not null"), "text_id")
    named = named.groupBy("matched").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = rows.where("size(texts) > 0").join(named, F.col("texts") == F.col("matched"), "left")
    found = found.select("doc_id", "n_words", "spans", F.coalesce("items", no_items).alias("items"))
    return rows.where("size(texts) = 0").select("doc_id", "n_words", "spans", no_items.alias("items")).union(found)


FOUND = "doc_id long, mark string, n_words long, spans array<struct<first: long, past: long>>, texts array<long>"


def _together(hits: list[DataFrame]) -> DataFrame:
    """What several blocks found in a text, a row for each text."""
    every = hits[0]
    for hit in hits[1:]:
        every = every.union(hit)
    return every.groupBy("mark", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.flatten(F.collect_list("texts"))).alias("texts")
    )


def _merged(found: DataFrame) -> DataFrame:
    """With the spans of several blocks as disjoint ones."""
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<first: bigint, past: bigint>>), (done, s) ->"
        " case when size(done) > 0 and s.first <= element_at(done, -1).past"
        " then concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,"
        " 'past', greatest(element_at(done, -1).past, s.past)))) else concat(done, array(s)) end)"
    )
    return found.withColumn("spans", F.array_sort("spans")).withColumn("spans", merged)


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    """``matches`` with n_hit, n_items and contaminated: any hit, and at least one word
    in ``share`` hit."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.past - s.first)")
    counted = found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long")})
    return counted.withColumn("contaminated", _contaminated(F.col("n_words"), F.col("n_hit"), share))


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per test suffix (item_id, item_word) with a match of at least its window: the
    length of its longest verbatim match over all documents and a place (doc_id, word)."""
    docs, items = _columns(docs, benchmark, doc_id, text, item_id, item_text)
    known = benchmark_of(items, window, block_bytes)
    found = empty(docs.sparkSession, schema := "text_id long, item_word long, length long, doc_id long, word long")
    for block in known.blocks():
        found = found.union(docs.mapInArrow(_by_suffix(block), schema))
    place = F.struct("length", (-F.col("doc_id")).alias("d"), (-F.col("word")).alias("w")).alias("place")
    best = found.select("text_id", "item_word", place).groupBy("text_id", "item_word").agg(F.max("place").alias("place"))
    best = best.join(known.ids, "text_id").groupBy("item_id", "item_word").agg(F.max("place").alias("place"))
    return best.select("item_id", "item_word", "place.length", (-F.col("place.d")).alias("doc_id"), (-F.col("place.w")).alias("word"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` without the contaminated ones; all columns stay. Each row is
    judged by its own text, with a benchmark of any size; ids are not looked at. With a
    benchmark of one block rows are judged where they are read; with several, what each
    block found is put together by the texts' SHA-256, and rows go by it."""
    _, items = _columns(docs, benchmark, doc_id, text, "item_id", "text")
    known = benchmark_of(items, window, block_bytes)
    if known.n <= 1:
        block = next(known.blocks(), None)
        if block is None:
            return docs

        @F.arrow_udf("struct<n_words: long, spans: array<struct<first: long, past: long>>>")
        def found(texts: pa.Array) -> pa.Array:
            n_words, spans, _ = _found(block, texts)
            return pa.StructArray.from_arrays([n_words, spans], ["n_words", "spans"])

        seen = found(F.col(text))
        n_hit = F.aggregate(seen.spans, F.lit(0).cast("long"), lambda n, s: n + s.past - s["first"])
        return docs.where(~_contaminated(seen.n_words, n_hit, SHARE))
    key = F.sha2(F.col(text), 256)
    texts = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), key.alias("mark"))
    hits = [
        stored(texts.mapInArrow(_by_document(block), FOUND).where("size(spans) > 0").dropDuplicates(["mark"]), "hits")
        for block in known.blocks()
    ]
    if not hits:
        return docs
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.past - s.first)")
    bad = _merged(_together(hits)).where(_contaminated(F.col("n_words"), n_hit, SHARE)).select("mark")
    name = free(docs, "mark")
    return bloom.without(docs.withColumn(name, key), name, stored(bad, "contaminated")).drop(name)


def _contaminated(n_words: Column, n_hit: Column, share: int) -> Column:
    return (n_hit > 0) & (share * n_hit >= n_words)
