"""Tables in hash buckets of their keys, for small updates of large tables.

All files of a table lie in one folder, each with the rows of one bucket, as Spark's bucketed
tables have them. A manifest (``snapshots``) names the files that hold the current rows; an
upsert reads and writes the files of the buckets its keys fall in, and publishes them in one
move. The files are read as a bucketed table, so that the join with the updates shuffles the
updates only, into the table's buckets: the target is read where it lies, and the merged
buckets are written by the tasks that read them.

Give a table so many buckets that one fits a task (a few hundred megabytes), and that an
update falls into few of them. One writer per table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import timedelta
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.sources import files, snapshots
from userflow.sources.tables import MERGE_KINDS

DATA = "_files"  # the folder of all files
_BUCKET = re.compile(r"_(\d{5})(?:\.c\d+)?\.")


class Buckets(NamedTuple):
    """What a manifest says of a table."""

    base: str
    keys: list[str]
    count: int
    schema: T.StructType
    held: dict[int, list[str]]  # the current files of each bucket that has rows

    def paths(self) -> list[str]:
        return [f"{self.base}/{DATA}/{name}" for names in self.held.values() for name in names]


def current(spark: SparkSession, root: str, name: str, number: int | None = None) -> Buckets:
    """The table as of its newest snapshot, or of an earlier one that is kept."""
    base = f"{root}/{name}"
    snapshot = snapshots.latest(spark, base) if number is None else snapshots.at(spark, base, number)
    if snapshot is None:
        raise ValueError(f"no bucketed table {name}")
    info = snapshot.info
    held = {int(bucket): names for bucket, names in info["held"].items()}
    return Buckets(base, info["keys"], info["count"], T.StructType.fromJson(info["schema"]), held)


def bucket_of(keys: Iterable[Column | str], count: int) -> Column:
    """The bucket of a key, as Spark's bucketed tables number them."""
    return F.pmod(F.hash(*keys), F.lit(count))


def create(rows: DataFrame, root: str, name: str, keys: list[str], count: int) -> None:
    """Make a table of ``rows``, which must hold no null key; an old one is replaced. Each file
    is sorted by the keys."""
    spark, base = rows.sparkSession, f"{root}/{name}"
    _refuse_null_keys(rows, keys)
    table = Buckets(base, keys, count, rows.schema, {})
    # A task for each bucket, so that a bucket is one file.
    dealt = rows.repartition(count, *keys)
    _publish(spark, table, _write(spark, table, dealt))


def read(spark: SparkSession, root: str, name: str, number: int | None = None, bucketed: bool = False) -> DataFrame:
    """The rows. With ``bucketed`` joins and aggregations on the keys need no shuffle of them,
    at the price of one task for each bucket."""
    table = current(spark, root, name, number)
    if bucketed:
        return _bucketed(spark, table, table.held)
    paths = table.paths()
    return spark.read.schema(table.schema).parquet(*paths) if paths else spark.createDataFrame([], table.schema)


def upsert(updates: DataFrame, root: str, name: str, insert: bool = True) -> dict[str, int]:
    """Update the rows that match ``updates`` on the table's keys, and with ``insert`` add the
    others. Returns how many rows matched, changed and were inserted, and how many buckets were
    written.

    Keys must be unique and not null in ``updates``, which is read several times: pass a table,
    not a long computation. A null value overwrites, a column that the updates lack stays, and
    is null in inserted rows. Rows of the target that share a key are all updated.
    """
    spark, table = updates.sparkSession, current(updates.sparkSession, root, name)
    unknown = set(updates.columns) - set(table.schema.names)
    if unknown or set(table.keys) - set(updates.columns):
        raise ValueError(f"updates need the keys {table.keys} and no columns beside the table's: {sorted(unknown)}")
    kinds = {f.name: f.dataType for f in table.schema}
    fresh = updates.select(*(F.col(c).cast(kinds[c]).alias(c) for c in updates.columns))
    _refuse_null_keys(fresh, table.keys)
    if not fresh.groupBy(*table.keys).count().where("count > 1").isEmpty():
        raise ValueError(f"updates hold several rows for one key of {table.keys}")
    # One row of at most ``count`` numbers.
    touched = fresh.agg(F.collect_set(bucket_of(table.keys, table.count))).first()[0]
    target = _bucketed(spark, table, {b: table.held[b] for b in touched if b in table.held})
    seen = Observation()
    merged = _merged(target, fresh, table.keys, insert)
    counted = merged.observe(seen, *(F.count_if(F.col("_merge") == m).alias(m) for m in MERGE_KINDS))
    made = _write(spark, table, counted.drop("_merge"))
    held = {b: names for b, names in table.held.items() if b not in touched}
    _publish(spark, table._replace(held=held), made)
    counts = seen.get if touched else dict.fromkeys(MERGE_KINDS, 0)
    return {
        "matched": counts["same"] + counts["modified"],
        "modified": counts["modified"],
        "inserted": counts["inserted"],
        "buckets": len(touched),
    }


def _merged(target: DataFrame, updates: DataFrame, keys: list[str], insert: bool) -> DataFrame:
    """One join on the keys: the target in its buckets, the updates shuffled into them."""
    values = [c for c in updates.columns if c not in keys]
    fresh = updates.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in values), F.lit(True).alias("_hit"))
    both = target.withColumn("_there", F.lit(True)).join(fresh.hint("shuffle_merge"), keys, "full_outer" if insert else "left_outer")
    hit, there = F.col("_hit").isNotNull(), F.col("_there").isNotNull()
    differs = reduce(or_, (~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in values), F.lit(False))
    kind = F.when(~there, "inserted").when(~hit, "untouched").when(differs, "modified").otherwise("same")
    return both.select(
        *(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns),
        kind.alias("_merge"),
    )


def _refuse_null_keys(rows: DataFrame, keys: list[str]) -> None:
    if not rows.where(reduce(or_, (F.col(k).isNull() for k in keys))).isEmpty():
        raise ValueError(f"rows without one of the keys {keys}")


def _register(spark: SparkSession, table: Buckets) -> str:
    """The folder of all files as a bucketed table of the session's catalog, for a moment."""
    name = f"userflow_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    keys = ", ".join(f"`{k}`" for k in table.keys)
    place = f"{table.base}/{DATA}".replace("'", "\\'")
    spark.sql(
        f"create table {name} ({columns}) using parquet"
        f" clustered by ({keys}) sorted by ({keys}) into {table.count} buckets location '{place}'"
    )
    return name


def _bucketed(spark: SparkSession, table: Buckets, held: dict[int, list[str]]) -> DataFrame:
    names = [name for own in held.values() for name in own]
    known = _register(spark, table)
    try:
        # Only these files are opened: the filter is on what the listing says of them.
        rows = spark.table(known).where(F.col("_metadata.file_name").isin(names) if names else F.lit(False))
        rows.schema  # resolved while the catalog knows it
        return rows
    finally:
        spark.sql(f"drop table {known}")


def _listed(spark: SparkSession, base: str) -> set[str]:
    names = (e.getPath().getName() for e in files.entries(spark, f"{base}/{DATA}"))
    return {name for name in names if not name.startswith(("_", "."))}


def _write(spark: SparkSession, table: Buckets, rows: DataFrame) -> dict[int, list[str]]:
    """Write rows that are dealt by bucket; the new files of each bucket."""
    before = _listed(spark, table.base)
    known = _register(spark, table)
    try:
        writer = rows.select(*table.schema.names).write.format("parquet").mode("append")
        writer.bucketBy(table.count, *table.keys).sortBy(*table.keys).saveAsTable(known)
    finally:
        spark.sql(f"drop table {known}")
    made: dict[int, list[str]] = {}
    for name in sorted(_listed(spark, table.base) - before):
        made.setdefault(int(_BUCKET.search(name)[1]), []).append(name)
    return made


def _publish(spark: SparkSession, table: Buckets, made: dict[int, list[str]]) -> None:
    held = {**table.held, **made}
    info = {"keys": table.keys, "count": table.count, "schema": table.schema.jsonValue(), "held": held}
    snapshots.publish(spark, table.base, {}, info=info)


def expire(spark: SparkSession, root: str, name: str, older_than: timedelta) -> int:
    """Delete snapshots that were replaced longer ago, and the files that no snapshot names and
    that are no newer than the oldest snapshot left; returns how many files went."""
    base = f"{root}/{name}"
    snapshots.expire(spark, base, older_than)
    kept = [snapshots.at(spark, base, n) for n in snapshots.numbers(spark, base)]
    if not kept:
        return 0
    named = {n for s in kept for names in s.info["held"].values() for n in names}
    oldest = files.modified(spark, f"{base}/{snapshots.MANIFESTS}/{kept[0].number:012d}.json")
    gone = 0
    for entry in files.entries(spark, f"{base}/{DATA}"):
        own = entry.getPath().getName()
        if not own.startswith(("_", ".")) and own not in named and entry.getModificationTime() <= oldest:
            files.delete(spark, f"{base}/{DATA}/{own}")
            gone += 1
    return gone
