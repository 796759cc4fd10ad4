"""Hierarchical packing of documents into windows of several context sizes.

A document's ids, end id included, are cut at the longest window. Full windows are
sequences of their own. Each rest goes to the tier of the smallest window that holds it.
Tiers are packed from the longest down: a rest opens a window of its tier, and the gap
is filled with the longest pieces that fit from shorter tiers; what then stays open is
closed by cutting a longer piece, unless the gap is too short for a piece worth reading.
A shorter window that cannot be filled grows to the longest one. The last rests of a
task go into windows of ever shorter powers of two.

Each task packs the documents of its own partition, some million ids at a time, so no
shuffle moves ids. Step groups get their share of every window size afterwards, out of
the counts per task.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm.tables import stored
from userflow.llm.tokens import Vocabulary, encoder

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
END = 1  # id put after each document
LEAST_CUT = 16  # ids of the shortest piece that a cut makes
POOL_IDS = 1 << 20  # rests that a task holds before it packs
STEP_IDS = 1 << 17  # ids of a step group
_TASK_BITS = 33  # sequences of one task are numbered below this


class Piece(NamedTuple):
    doc: int | None
    start: int
    ids: np.ndarray
    total: int


class Pool:
    """Pieces by length."""

    def __init__(self):
        self.queues: list[deque[Piece]] = [deque() for _ in range(WINDOW + 1)]
        self.lengths = 0  # bit i: there is a piece of i ids
        self.held = 0

    def add(self, piece: Piece) -> None:
        size = len(piece.ids)
        self.queues[size].append(piece)
        self.lengths |= 1 << size
        self.held += size

    def take(self, size: int) -> Piece:
        queue = self.queues[size]
        piece = queue.popleft()
        if not queue:
            self.lengths &= ~(1 << size)
        self.held -= size
        return piece

    def longest(self, most: int = WINDOW) -> int:
        """The greatest length up to ``most``; 0 without any."""
        return max((self.lengths & ((2 << most) - 1)).bit_length() - 1, 0)

    def shortest(self, least: int) -> int:
        """The smallest length from ``least`` on; 0 without any."""
        above = self.lengths >> least
        return (above & -above).bit_length() - 1 + least if above else 0

    def cut(self, size: int, length: int) -> Piece:
        """The first ``size`` ids of a piece of ``length``; the rest stays."""
        piece = self.take(length)
        self.add(Piece(piece.doc, piece.start + size, piece.ids[size:], piece.total))
        return piece._replace(ids=piece.ids[:size])


def _filled(pool: Pool, pieces: list[Piece], gap: int) -> int:
    """Fills up to ``gap`` ids and returns how many stay open."""
    while gap:
        fits = pool.longest(gap)
        if fits:
            pieces.append(pool.take(fits))
            gap -= fits
            continue
        longer = (pool.shortest(gap + LEAST_CUT) or pool.shortest(gap + 1)) if gap >= LEAST_CUT else 0
        if longer:
            pieces.append(pool.cut(gap, longer))
            gap = 0
        break
    return gap


def _windows(pool: Pool, until: int) -> Iterator[list[Piece]]:
    """Packs the longest rests first until the pool holds no more than ``until`` ids."""
    while pool.held > until:
        first = pool.longest()
        tier = min(t for t in TIERS if t >= first)
        pieces = [pool.take(first)]
        gap = _filled(pool, pieces, tier - first)
        if gap and tier < WINDOW:
            gap = _filled(pool, pieces, WINDOW - tier + gap)
        if gap >= LEAST_CUT:  # the pool is empty
            yield from _powers(pieces)
        else:
            yield pieces


def _powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The ids of the pieces in windows of descending powers of two, none padded."""
    left = sum(len(p.ids) for p in pieces)
    queue = deque(pieces)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        window: list[Piece] = []
        while size:
            piece = queue.popleft()
            if len(piece.ids) > size:
                queue.appendleft(Piece(piece.doc, piece.start + size, piece.ids[size:], piece.total))
                piece = piece._replace(ids=piece.ids[:size])
            window.append(piece)
            size -= len(piece.ids)
        yield window


SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window long, place long"
)
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def _packed(vocabulary: Vocabulary):
    def batch_of(windows: list[list[Piece]], first: int, placed: Counter) -> pa.RecordBatch:
        rows = []
        for number, pieces in enumerate(windows, first):
            size, offset = sum(len(piece.ids) for piece in pieces), 0
            window = size if size.bit_count() == 1 else WINDOW
            for piece in pieces:
                own = (piece.doc, piece.start, len(piece.ids), piece.ids.tobytes(), piece.total, number, offset)
                rows.append((*own, window, placed[window]))
                offset += len(piece.ids)
            placed[window] += 1
        types = [pa.binary() if name == "ids" else pa.int64() for name in _NAMES]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pool = encoder(vocabulary), Pool()
        number = TaskContext.get().partitionId() << _TASK_BITS
        done: list[list[Piece]] = []
        placed: Counter[int] = Counter()  # sequences of each window size so far
        waiting = 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(own.ids(text.as_py()), np.uint32(END)).astype("<u4")
                for start in range(0, len(ids), WINDOW):
                    piece = Piece(doc.as_py(), start, ids[start : start + WINDOW], len(ids))
                    if len(piece.ids) == WINDOW:
                        done.append([piece])
                    else:
                        pool.add(piece)
                waiting += len(ids)
                if pool.held >= POOL_IDS:
                    done += _windows(pool, POOL_IDS // 2)
                if done and waiting >= POOL_IDS:
                    yield batch_of(done, number, placed)
                    number += len(done)
                    done, waiting = [], 0
        done += _windows(pool, 0)
        if done:
            yield batch_of(done, number, placed)

    return run


def pack(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all rows of ``docs``: doc_id, start (ids of the document before it),
    length, ids (little-endian 32-bit), doc_tokens (of the whole document, with the end
    id), sequence_id, offset (place in its sequence, without gaps from 0), window (ids of
    the sequence when padded), place (of the sequence among its task's of that window).

    Null and empty texts are an end id alone. Repeated rows and rows without an id are
    documents of their own. An empty table has no pieces. Other columns are not looked
    at. sequence_id follows the input's partitions: write the result before using it twice.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(_packed(vocabulary), SCHEMA)


def with_step_groups(pieces: DataFrame, step_ids: int = STEP_IDS) -> DataFrame:
    """``pieces`` (written ones) with step_group: groups of about ``step_ids`` ids; of each
    window size all groups get the same number of sequences, but for one. Only the counts
    per task are shuffled."""
    tasked = pieces.withColumn("task", F.shiftright("sequence_id", _TASK_BITS))
    counts = tasked.groupBy("task", "window").agg((F.max("place") + 1).alias("n"))
    before = Window.partitionBy("window").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "sequence-counts")
    groups = max(1, -(-(counts.agg(F.sum(F.col("n") * F.col("window"))).first()[0] or 0) // step_ids))
    group = F.pmod(F.col("before") + F.col("place"), F.lit(groups)).alias("step_group")
    kept = [c for c in pieces.columns if c != "place"]
    return tasked.join(counts.drop("n"), ["task", "window"]).select(*kept, group)
