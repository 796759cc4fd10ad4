"""Bloom filters as DataFrame expressions: built by aggregation, probed without a join."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.tables import free

LEAST_BITS = 1 << 16
MOST_BITS = 1 << 27  # of a filter on ids, 16 MB
FEW_IDS = 1 << 20  # a table of ids that Spark's own size check may broadcast
_CHUNK = 1 << 10  # 64-bit words of a chunk


class Filter(NamedTuple):
    """A filter's shape and its bits, an array of chunks that a one-row query yields."""

    bits: int
    hashes: int
    salt: int
    chunks: DataFrame

    def contains(self, key: Column) -> Column:
        """True for every key put in and for few others; null never passes."""
        chunks = self.chunks.scalar()
        found = None
        for place in _places(key, self.bits, self.hashes, self.salt):
            word = F.shiftright(place, 6)
            chunk = chunks[F.shiftright(word, 10).cast("int")]
            bit = F.getbit(chunk[word.bitwiseAND(F.lit(_CHUNK - 1)).cast("int")], place.bitwiseAND(F.lit(63)).cast("int")) == 1
            found = bit if found is None else found & bit
        return key.isNotNull() & found


def _places(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    # The hash takes its arguments from left to right: with the key last, keys that collide
    # under one salt and number part again under the others.
    return [F.xxhash64(F.lit(salt), F.lit(i), key).bitwiseAND(F.lit(bits - 1)) for i in range(hashes)]


def bits_for(keys: int, per_key: float, most: int) -> int:
    """A power of two with about ``per_key`` bits for each key, at most ``most``."""
    bits = LEAST_BITS
    while bits < keys * per_key and bits < most:
        bits *= 2
    return bits


def build(keys: DataFrame, key: str, bits: int, hashes: int, salt: int = 0) -> Filter:
    """The filter of the column ``key``; ``bits`` a power of two from LEAST_BITS on. Its
    size does not depend on the keys, so that it may be sent to every task."""
    spark = keys.sparkSession
    places = keys.select(F.explode(F.array(*_places(F.col(key), bits, hashes, salt))).alias("place"))
    words = places.select(
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"),
    )
    blank = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = words.union(blank).groupBy("word").agg(F.bit_or("bit").alias("bits"))

    def ordered(by: str, value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(by, value))), lambda x: x[value])

    chunks = words.groupBy(F.shiftright("word", 10).alias("chunk")).agg(ordered("word", "bits").alias("bits"))
    return Filter(bits, hashes, salt, chunks.agg(ordered("chunk", "bits").alias("chunks")))


def without(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is not among ``ids`` (written, one column); rows with a
    null stay. Few ids are left to Spark's choice of join; with more, a filter lets only
    rows that may go into the join's shuffle, the others stay where they are read."""
    name = free(rows, "gone")
    gone = ids.toDF(name)

    def left(some: DataFrame) -> DataFrame:
        return some.join(gone, F.col(column) == F.col(name), "left_anti")

    n = ids.count()
    if n <= FEW_IDS:
        return left(rows)
    maybe = build(gone, name, bits_for(n, 16, MOST_BITS), 2).contains(F.col(column).cast(gone.schema[0].dataType))
    return rows.where(~maybe).unionByName(left(rows.where(maybe)))
