"""Finding rows without opening files that cannot hold them.

``index`` notes for each file of a table the bounds of some columns and, for others, a small
filter of the values it holds. ``find`` asks these notes which files a predicate may match and
reads those only; the predicate itself is applied to every row that is read, so that notes can
only save work. A note counts for a file of the same path, size and time: files written since
are read as if nothing were known of them, and notes on an earlier version go unused.

Notes pay off where alike rows share files: ``clustered`` lays rows out so.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.sources import snapshots, tables

NOTES = "_notes"  # the folder of a table that holds its notes
PAGE = 32_768  # bits of one bitmap, as Spark's bitmap functions have them
BITS = 16  # bits for each value of the fullest file; with two places a value, 1.4 % pass by chance
LONGEST = 64  # characters of a text bound
MOST_FILES = 10_000  # a predicate that meets more files than this reads the table as it is


class Between(NamedTuple):
    """Values from ``low`` to ``high``, both included; None leaves a side open. Never null."""

    low: object = None
    high: object = None


class Notes(NamedTuple):
    """The notes on a table: a row for each file, and the bitmaps of its values."""

    files: DataFrame
    members: DataFrame
    pages: dict[str, int]  # bitmaps a file has at most, by column
    bounds: list[str]


_IDENTITY = ("file_path", "file_size", "file_modification_time")

# Python values that are looked up in a column as they are. Others are left to the rows.
_ALIKE = {
    str: (T.StringType,),
    int: (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    Decimal: (T.DecimalType,),
    float: (T.DoubleType,),
    date: (T.DateType,),
    datetime: (T.TimestampType, T.TimestampNTZType),
}


def clustered(rows: DataFrame, by: list[str], into: int) -> DataFrame:
    """``rows`` in ranges of the columns ``by``, to be written as that many files.

    Rows that share a key spread over several ranges by a hash of the whole row, so that a key
    of a third of all rows is no single task's; only equal rows stay together. Columns that
    cannot be hashed (maps, variants) do not take part in that.
    """
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return rows.repartitionByRange(into, *by, F.xxhash64(*plain)).sortWithinPartitions(*by)


# -- notes -----------------------------------------------------------------------


def index(spark: SparkSession, root: str, name: str, bounds: Iterable[str] = (), members: Iterable[str] = ()) -> None:
    """Note the bounds of some columns and the values of others, for each file of the table's
    current version. Both passes aggregate within the scan's tasks and shuffle a row for each
    file, and a bitmap of 4 KB for each page of its values. A repeated call replaces the notes.
    """
    path, bounds, members = tables.table_path(spark, root, name), list(bounds), list(members)
    rows = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in rows.schema}
    identity = [F.col(f"_metadata.{c}").alias(c) for c in _IDENTITY]
    edges = [
        F.struct(
            F.min(_bound(F.col(c), kinds[c])).alias("low"),
            F.max(_bound(F.col(c), kinds[c])).alias("high"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
        ).alias(f"bounds_{c}")
        for c in bounds
    ]
    sizes = [F.approx_count_distinct(c).alias(f"distinct_{c}") for c in members]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in members]
    each = rows.select(*identity, *dict.fromkeys(bounds + members)).groupBy(*_IDENTITY)
    noted = each.agg(F.count(F.lit(1)).alias("rows"), *edges, *sizes, *nulls)
    base = f"{root}/{name}/{NOTES}"
    version = tables.stage(noted, base, "files", make=True)
    if version is None:  # an empty table has no file to skip
        return
    by_file = spark.read.parquet(f"{base}/files/{version}")
    fullest = by_file.agg(F.count(F.lit(1)), *(F.max(f"distinct_{c}") for c in members)).first()
    pages = {c: -(-BITS * max(n or 0, 1) // PAGE) for c, n in zip(members, fullest[1:], strict=True)}
    held = tables.stage(_bitmaps(rows, pages), base, "members") if members else None
    known = {"files": version, **({"members": held} if held else {})}
    info = {"path": path, "bounds": bounds, "pages": pages, "members": held is not None}
    snapshots.publish(spark, base, known, info=info)


def _bitmaps(rows: DataFrame, pages: dict[str, int]) -> DataFrame:
    """Which places of its bitmaps each file's values take, a row for each page that has any."""
    marks = [F.struct(F.lit(c).alias("column"), p.alias("place")) for c, n in pages.items() for p in _places(F.col(c), n)]
    taken = rows.select(F.col("_metadata.file_path").alias("file_path"), F.explode(F.array(*marks)).alias("at"))
    place = F.col("at.place")
    bitmaps = (
        taken.where(place.isNotNull())
        .groupBy("file_path", F.col("at.column").alias("column"), F.floor(place / PAGE).alias("page"))
        .agg(F.bitmap_construct_agg(place % PAGE).alias("bits"))
    )
    # A lookup reads the row groups of its pages only.
    return bitmaps.repartitionByRange("column", "page", "file_path").sortWithinPartitions("column", "page")


def _places(value: Column, pages: int) -> list[Column]:
    """Where a value stands in the bitmaps of a column; nowhere if it is null. The salt comes
    first, so that two values that meet in one place do not meet in the other by the same."""
    return [F.when(value.isNotNull(), F.pmod(F.xxhash64(F.lit(salt), value), F.lit(pages * PAGE))) for salt in (1, 2)]


def _bound(value: Column, kind: T.DataType) -> Column:
    """What is compared of a value: the beginning of a text, else all. Texts in order begin in
    order."""
    return F.substring(value, 1, LONGEST) if isinstance(kind, T.StringType) else value


def notes(spark: SparkSession, root: str, name: str, path: str) -> Notes | None:
    """The notes on the version of a table that is at ``path``; None without them."""
    newest = snapshots.latest(spark, f"{root}/{name}/{NOTES}")
    if newest is None or newest.info["path"] != path:
        return None
    if newest.info["members"]:
        members = spark.read.parquet(newest.path("members"))
    else:
        members = spark.createDataFrame([], "file_path string, column string, page bigint, bits binary")
    return Notes(spark.read.parquet(newest.path("files")), members, newest.info["pages"], newest.info["bounds"])


# -- reading ---------------------------------------------------------------------


def find(
    spark: SparkSession,
    root: str,
    name: str,
    where: Mapping[str, object],
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """``tables.find`` for a mapping of column to what it must be: a value, None, a list of
    values (None among them matches null), or ``Between``. All must hold."""
    path = tables.table_path(spark, root, name)
    rows, met = spark.read.parquet(path), condition(where)
    paths = files_of(spark, root, name, where, path)
    if paths is not None:
        rows = rows.where(F.col("_metadata.file_path").isin(paths) if paths else F.lit(False))
    return tables.find_rows(rows, met, columns)


def condition(where: Mapping[str, object]) -> Column:
    """The condition on rows that such a mapping stands for."""
    return reduce(and_, (_holds(F.col(c), v) for c, v in where.items()), F.lit(True))


def _holds(column: Column, value: object) -> Column:
    if isinstance(value, Between):
        sides = [column >= F.lit(value.low)] if value.low is not None else []
        sides += [column <= F.lit(value.high)] if value.high is not None else []
        return reduce(and_, sides, column.isNotNull())
    return reduce(or_, (column.isNull() if v is None else column == F.lit(v) for v in _values(value)), F.lit(False))


def _values(value: object) -> list:
    return list(value) if isinstance(value, (list, set, frozenset)) else [value]


def files_of(spark: SparkSession, root: str, name: str, where: Mapping[str, object], path: str | None = None) -> list[str] | None:
    """The files that may hold matching rows, those without a note among them; None if the
    notes say nothing, or if they leave more than ``MOST_FILES``."""
    path = path or tables.table_path(spark, root, name)
    known = notes(spark, root, name, path)
    if known is None:
        return None
    kinds = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    alike = {c: v for c, v in where.items() if _comparable(v, kinds[c])}
    room = [_within_bounds(c, v, kinds[c]) for c, v in alike.items() if c in known.bounds]
    sought = {c: _values(v) for c, v in alike.items() if c in known.pages and not isinstance(v, Between)}
    if not room and not sought:
        return None
    # A listing of the folder: no file is opened for it.
    there = spark.read.format("binaryFile").load(path).select(*(F.col(f"_metadata.{c}").alias(c) for c in _IDENTITY))
    both = there.join(known.files.withColumn("_noted", F.lit(True)), list(_IDENTITY), "left")
    for c, values in sought.items():
        own = [v for v in values if v is not None]
        met = F.col(f"nulls_{c}") > 0 if None in values else F.lit(False)
        if own:
            held = _holders(known, c, own, kinds[c]).withColumn(f"_held_{c}", F.lit(True))
            both = both.join(held, "file_path", "left")
            met = met | F.coalesce(F.col(f"_held_{c}"), F.lit(False))
        room.append(met)
    # What cannot be told keeps the file.
    met = F.coalesce(reduce(and_, room), F.lit(True))
    kept = both.where(F.col("_noted").isNull() | met).select("file_path")
    paths = kept.limit(MOST_FILES + 1).agg(F.collect_list("file_path")).first()[0]
    return None if len(paths) > MOST_FILES else paths


def _comparable(value: object, kind: T.DataType) -> bool:
    given = list(value) if isinstance(value, Between) else _values(value)
    alike = all(v is None or isinstance(kind, _ALIKE.get(type(v), ())) for v in given)
    # Texts under a collation are equal without being the same.
    return alike and (not isinstance(kind, T.StringType) or kind == T.StringType())


def _within_bounds(column: str, value: object, kind: T.DataType) -> Column:
    """Whether a file's bounds leave room for the values."""
    edge = F.col(f"bounds_{column}")

    def cut(v: object) -> Column:
        return _bound(F.lit(v), kind)

    if isinstance(value, Between):
        sides = [edge.high >= cut(value.low)] if value.low is not None else []
        sides += [edge.low <= cut(value.high)] if value.high is not None else []
        # A file of nulls alone has no bounds, and no row between any.
        return reduce(and_, sides, edge.low.isNotNull())
    given = (edge.nulls > 0 if v is None else (edge.low <= cut(v)) & (edge.high >= cut(v)) for v in _values(value))
    return reduce(or_, (F.coalesce(g, F.lit(False)) for g in given), F.lit(False))


def _holders(known: Notes, column: str, values: list, kind: T.DataType) -> DataFrame:
    """The files whose bitmaps have all places of one of the values."""
    pages = known.pages[column]
    one = [
        F.struct(F.lit(n).alias("value"), p.alias("place"))
        for n, v in enumerate(values)
        for p in _places(F.lit(v).try_cast(kind), pages)
    ]
    asked = known.files.sparkSession.range(1).select(F.explode(F.array_distinct(F.array(*one))).alias("at"))
    asked = asked.select("at.value", "at.place", F.floor(F.col("at.place") / PAGE).alias("page"))
    needed = asked.groupBy("value").agg(F.count("place").alias("n")).where("n > 0")
    within = F.col("place") % PAGE
    byte = F.substring("bits", (within / 8).cast("int") + 1, F.lit(1))
    taken = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (within % 8).cast("int")) == 1
    own = known.members.where(F.col("column") == column).join(asked, "page").where(taken)
    found = own.groupBy("file_path", "value").agg(F.count("place").alias("n"))
    return found.join(needed, ["value", "n"], "left_semi").select("file_path").distinct()


def expire(spark: SparkSession, root: str, name: str, older_than: timedelta) -> int:
    """Delete notes that were replaced longer ago."""
    return snapshots.expire(spark, f"{root}/{name}/{NOTES}", older_than)
