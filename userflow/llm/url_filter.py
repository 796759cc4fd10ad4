"""URL rules, and a Bloom filter cascade for listed keys.

The first level encodes the listed keys. Over all keys of the corpus some others pass it;
the second level encodes those. Some listed keys pass the second; the third encodes them,
and so on until none passes. A key is then listed exactly when the first level that it
does not pass is an even one (or it passes all, and their number is odd). The levels are
small arrays that each task holds, so that membership needs no join and is exact for every
key of the universe that the cascade was built over. Building joins once: the few keys that
pass the first level are held against the listed ones.

Urls are written by strangers, who may choose keys that collide. Every level hashes anew, and
after MOST_LEVELS levels the keys still left are held as they are (the residue), so that the
cascade ends whatever the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm import bloom
from userflow.llm.tables import stored

FIRST_BITS, FIRST_HASHES = 12, 6  # of the first level, for each listed key
LATER_BITS, LATER_HASHES = 6, 3
MOST_BITS = 1 << 28  # of a level, 32 MB
MOST_KEYS = MOST_BITS // FIRST_BITS  # beyond, membership is by a join
MOST_LEVELS = 16  # some 22 million keys take seven
MOST_RESIDUE, RESIDUE_BYTES = 1 << 12, 1 << 20  # keys left after them, beyond is a join

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z as a-z; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, ASCII_UPPER, ASCII_UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? or #; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null: the rule's host is the
    url's or a parent domain of it, and the url's path starts with the rule's. Meant for
    short lists of hand-made rules; long lists of keys belong into a cascade."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fitting))


class Cascade(NamedTuple):
    levels: list[bloom.Filter]
    residue: DataFrame | None = None  # one row: keys that pass the last level but are not in it

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed; false for null."""
        listed = F.lit(len(self.levels) % 2 == 1)
        if self.residue is not None:
            listed = F.array_contains(self.residue.scalar(), key) != listed
        for number in range(len(self.levels), 0, -1):
            listed = F.when(self.levels[number - 1].contains(key), listed).otherwise(F.lit(number % 2 == 0))
        return listed & key.isNotNull()


def cascade(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade | None:
    """A cascade of the keys of ``listed`` over those of ``universe``; repeats and nulls
    are left out. Without listed keys it has no level. None when there are more than
    MOST_KEYS, or more than MOST_RESIDUE (or RESIDUE_BYTES of them) after MOST_LEVELS: it
    would be too large for every task to hold."""
    inside = stored(listed.select(key).where(F.col(key).isNotNull()).distinct(), "listed")
    n = inside.count()
    if n > MOST_KEYS:
        return None
    levels: list[bloom.Filter] = []
    outside = None
    while n and len(levels) < MOST_LEVELS:
        first = not levels
        bits = bloom.bits_for(n, FIRST_BITS if first else LATER_BITS, MOST_BITS)
        level = bloom.build(inside, key, bits, FIRST_HASHES if first else LATER_HASHES, salt=len(levels) + 1)
        level = level._replace(chunks=stored(level.chunks, "level"))
        levels.append(level)
        if first:
            passed = universe.select(key).where(level.contains(F.col(key))).distinct().join(inside, key, "left_anti")
        else:
            passed = outside.where(level.contains(F.col(key)))
        # What passed is encoded next; what was encoded is then held against that.
        outside, inside = inside, stored(passed, "passed")
        n = inside.count()
    if not n:
        return Cascade(levels)
    if n > MOST_RESIDUE or inside.agg(F.sum(F.octet_length(F.col(key).cast("string")))).first()[0] > RESIDUE_BYTES:
        return None
    return Cascade(levels, stored(inside.agg(F.collect_set(key).alias("keys")), "residue"))


def with_listed(rows: DataFrame, listed: DataFrame, key: str = "key", out: str = "listed") -> DataFrame:
    """``rows`` with whether their key is among those of ``listed``. All rows stay, with
    all columns; a null key is not listed; ``out`` must not be a column yet."""
    built = cascade(listed, rows, key)
    if built is not None:
        return rows.withColumn(out, built.contains(F.col(key)))
    known = listed.select(F.col(key).alias("__listed")).where("__listed is not null").distinct()
    joined = rows.join(known, F.col(key) == F.col("__listed"), "left")
    return joined.withColumn(out, F.col("__listed").isNotNull()).drop("__listed")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, listed.

    verdict is the longest fitting rule's; without one it is block for a key (host and
    path together) of ``listed`` (key), else allow. A null url, or one without ://, has
    an empty host and path. Repeated rows are each returned; other columns are not looked
    at; an empty table gives an empty result.
    """
    parts = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    keyed = with_listed(parts.withColumn("key", F.concat("host", "path")), listed)
    rule = ruled(F.col("host"), F.col("path"), rules)
    judged = keyed.withColumn("ruled", rule)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict"), "listed"
    )
