"""One snapshot for all tables of a root.

A snapshot is a numbered file below the root, the manifest, that names the version of each
table. Publishing writes a manifest under another name and then moves it to the next number,
in one rename that never replaces a file: a reader sees all tables of one snapshot or all of
the one before, and of two writers that publish at once one comes second and adds its tables
to what the first has published. A publish that is cut off leaves the snapshot before it. The
file system must refuse a rename onto a file in one step, as HDFS does; where it does not, as
on a local disk, only the writers of one driver are kept apart, by taking turns.

The tables of the latest manifest are what ``tables.table`` reads. ``latest`` or ``at`` hold
on to one snapshot, so that several tables can be read as they were together, however many
snapshots are published meanwhile.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime, timedelta
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.sources import files

MANIFESTS = "_snapshots"
TRIES = 50  # of a publish, each lost to another writer
_NAME = re.compile(r"(\d{12})\.json")
_TIME = "%Y%m%dT%H%M%S.%f"
_turn = threading.Lock()


class Snapshot(NamedTuple):
    root: str
    number: int
    published: str
    batch_id: int | None
    versions: dict[str, str]  # of each table the folder below it that holds its rows
    info: dict  # what else its writer noted

    def path(self, name: str) -> str:
        if name not in self.versions:
            raise ValueError(f"snapshot {self.number} holds no table {name}")
        return f"{self.root}/{name}/{self.versions[name]}"

    def table(self, spark: SparkSession, name: str, schema: str | T.StructType | None = None) -> DataFrame:
        """A table's rows as of this snapshot."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self.path(name))


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The snapshots that are kept, ascending."""
    names = (_NAME.fullmatch(e.getPath().getName()) for e in files.entries(spark, f"{root}/{MANIFESTS}"))
    return sorted(int(name[1]) for name in names if name)


def at(spark: SparkSession, root: str, number: int) -> Snapshot:
    """One of the snapshots that are kept."""
    text = files.read_text(spark, f"{root}/{MANIFESTS}/{number:012d}.json")
    if text is None:
        raise ValueError(f"no snapshot {number} of {root}")
    held = json.loads(text)
    return Snapshot(root, number, held["published"], held["batch_id"], held["versions"], held["info"])


def latest(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest snapshot; None before the first."""
    kept = numbers(spark, root)
    return at(spark, root, kept[-1]) if kept else None


def version_of(spark: SparkSession, root: str, name: str) -> str | None:
    """The version of a table in the newest snapshot; None if it names no such table."""
    newest = latest(spark, root)
    return None if newest is None else newest.versions.get(name)


def publish(
    spark: SparkSession, root: str, versions: Mapping[str, str], batch_id: int | None = None, info: Mapping | None = None
) -> Snapshot:
    """Make written versions the current ones of their tables, all in one move. Tables that
    are not named keep theirs. ``info`` is noted with the snapshot, as JSON."""
    for _ in range(TRIES):
        with _turn:
            before = latest(spark, root)
            number = before.number + 1 if before else 1
            every = {**(before.versions if before else {}), **versions}
            made = Snapshot(root, number, f"{datetime.now(UTC):{_TIME}}", batch_id, every, dict(info or {}))
            text = {"published": made.published, "batch_id": batch_id, "versions": every, "info": made.info}
            draft = f"{root}/{MANIFESTS}/.draft-{uuid.uuid4().hex}"
            files.write_text(spark, draft, json.dumps(text))
            if files.move(spark, draft, f"{root}/{MANIFESTS}/{number:012d}.json", replace=False):
                return made
    raise RuntimeError(f"other writers published to {root} {TRIES} times")


def expire(spark: SparkSession, root: str, older_than: timedelta) -> int:
    """Delete the snapshots that were replaced longer than ``older_than`` ago, and the
    versions of their tables that no later snapshot names; returns how many snapshots went.
    The newest always stays. Versions that are newer than all named ones, which a writer may
    be about to publish, stay too."""
    limit = f"{datetime.now(UTC) - older_than:{_TIME}}"
    kept = [at(spark, root, n) for n in numbers(spark, root)]
    gone = [s for s, after in zip(kept, kept[1:], strict=False) if after.published < limit]
    left = kept[len(gone) :]
    for old in gone:  # first, so that no snapshot names what is deleted
        files.delete(spark, f"{root}/{MANIFESTS}/{old.number:012d}.json")
    for name in {name for s in gone for name in s.versions}:
        named = {s.versions[name] for s in left if name in s.versions}
        folder = {v.rpartition("/")[0] for s in kept for t, v in s.versions.items() if t == name}
        for part in folder:
            for entry in files.entries(spark, f"{root}/{name}/{part}"):
                version = f"{part}/{entry.getPath().getName()}"
                if version not in named and named and version < min(named):
                    files.delete(spark, f"{root}/{name}/{version}")
    return len(gone)


# -- differences -----------------------------------------------------------------

KINDS = ("added", "removed", "changed")


def changes(older: DataFrame, newer: DataFrame, keys: list[str]) -> DataFrame:
    """What turns the rows of ``older`` into those of ``newer``, by key: the keys, ``_change``
    (added, removed or changed), and for each other column its old and its new value, as
    ``old_`` and ``new_`` and the name.

    Keys are unique in each of the two; a null key matches null, and a null value differs from
    any but null. A column that one of the two lacks is null there. Rows alike are left out.
    """
    kinds = {f.name: f.dataType for f in [*newer.schema, *older.schema]}
    values = [c for c in kinds if c not in keys]

    def side(rows: DataFrame, name: str) -> DataFrame:
        held = set(rows.columns)
        return rows.select(
            *(F.col(k).alias(f"{name}_key_{k}") for k in keys),
            *((F.col(c) if c in held else F.lit(None).cast(kinds[c])).alias(f"{name}_{c}") for c in values),
            F.lit(True).alias(f"{name}_there"),
        )

    same = reduce(and_, (F.col(f"old_key_{k}").eqNullSafe(F.col(f"new_key_{k}")) for k in keys))
    differs = reduce(or_, (~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in values), F.lit(False))
    both = side(older, "old").join(side(newer, "new"), same, "full_outer")
    kind = F.when(F.col("old_there").isNull(), "added").when(F.col("new_there").isNull(), "removed").when(differs, "changed")
    there = F.col("new_there").isNotNull()
    return both.select(
        *(F.when(there, F.col(f"new_key_{k}")).otherwise(F.col(f"old_key_{k}")).alias(k) for k in keys),
        kind.alias("_change"),
        *(F.col(f"{name}_{c}") for c in values for name in ("old", "new")),
    ).where("_change is not null")


def changes_between(
    spark: SparkSession, root: str, name: str, keys: list[str], since: int | None, until: int | None = None
) -> DataFrame:
    """``changes`` of a table from snapshot ``since`` (None: before its first rows) to ``until``
    (None: the newest)."""
    newer = (latest(spark, root) if until is None else at(spark, root, until)).table(spark, name)
    older = newer.where(F.lit(False)) if since is None else at(spark, root, since).table(spark, name)
    return changes(older, newer, keys)


def apply_changes(rows: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` after the ``changes`` of ``feed``: the newer rows again."""
    values = [c for c in rows.columns if c not in keys]

    def same() -> Column:
        return reduce(and_, (F.col(f"old.{k}").eqNullSafe(F.col(f"feed.{k}")) for k in keys))

    kept = rows.alias("old").join(feed.alias("feed"), same(), "left_anti")
    fresh = feed.where("_change <> 'removed'").select(*keys, *(F.col(f"new_{c}").alias(c) for c in values))
    return kept.unionByName(fresh)
