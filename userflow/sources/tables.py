"""Result tables: find, append, replace, keyed upsert, document text.

A table is a directory under a root path. ``replace`` and ``upsert`` write a new
version below it and then move a one-line pointer file over the old pointer, so a
reader sees the old rows or the new rows and never an empty or half-written table.
Replaced versions stay until ``expire`` is called. ``append`` adds parquet files to the
current version: a reader may see some of them before the others, and a repeated append
adds its rows again. ``upsert_dated`` keeps a table as one folder per date and rewrites
touched dates in place. One writer per table.

Tables that a snapshot names (``snapshots``) are read at its version, and their writers
publish by the next snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from datetime import UTC, datetime, timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.functions.times import utc_text
from userflow.sources import files, snapshots

# Spark skips names with a leading underscore when it lists a table directory.
POINTER = "_current"
VERSIONS = "_versions"
# What Spark's streaming file sink keeps beside its files; its readers go by it.
STREAM_LOG = "_spark_metadata"
# The folder level of a table that is laid out by date.
DATE = "row_date"


# -- reading ---------------------------------------------------------------------


def table_path(spark: SparkSession, root: str, name: str) -> str:
    """Directory that holds the current rows of a table."""
    version = _current(spark, root, name)
    return f"{root}/{name}/{version}" if version else f"{root}/{name}"


def exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether anything was written to a table yet."""
    if _current(spark, root, name) is not None:
        return True
    return any(True for _ in _visible(spark, f"{root}/{name}"))


def is_stream_table(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the table was written by a stream in append mode."""
    _, place, fs = files.hadoop(spark, f"{root}/{name}/{STREAM_LOG}")
    return fs.exists(place)


def _visible(spark: SparkSession, base: str) -> Iterator:
    """What a reader of a directory sees, fetched entry by entry."""
    for entry in files.entries(spark, base):
        if not entry.getPath().getName().startswith(("_", ".")):
            yield entry


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, root, name))


def find(
    spark: SparkSession,
    root: str,
    name: str,
    where: Column | str | Mapping[str, object] | None = None,
    columns: Iterable[str] | None = None,
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Rows of a table; predicate and projection reach the parquet scan. With a
    ``schema``, a table that was not written yet has no rows, and a written one is read
    without a look at its files first."""
    if schema is None:
        rows = table(spark, root, name)
    elif exists(spark, root, name):
        rows = spark.read.schema(schema).parquet(table_path(spark, root, name))
    else:
        rows = spark.createDataFrame([], schema)
    return find_rows(rows, where, columns)


def find_rows(
    rows: DataFrame,
    where: Column | str | Mapping[str, object] | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Matching rows. No predicate gives all rows, no (or an empty) projection all
    columns."""
    if where is not None:
        rows = rows.where(condition(where))
    columns = list(columns or ())
    return rows.select(*columns) if columns else rows


def condition(where: Column | str | Mapping[str, object]) -> Column:
    """A condition as it is, as SQL text, or as a mapping of column to value that
    must all be equal, with None matching null."""
    if isinstance(where, str):
        return F.expr(where)
    if isinstance(where, Mapping):
        return reduce(
            and_,
            (
                F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
                for c, v in where.items()
            ),
            F.lit(True),
        )
    return where


# -- writing ---------------------------------------------------------------------


def append(df: DataFrame, root: str, name: str, with_id: bool = False) -> None:
    """Add rows; ``with_id`` gives each a unique ``_id``.

    A table keeps the columns of its first rows: later rows get null for those they
    lack and must not bring others.
    """
    spark = df.sparkSession
    _refuse_stream_table(spark, root, name)
    if with_id:
        df = df.withColumn("_id", F.uuid())
    if exists(spark, root, name):
        schema = table(spark, root, name).schema
        _refuse_unknown(df.columns, schema.names)
        df = df.select(
            *(
                (F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in schema
            )
        )
    df.write.mode("append").parquet(table_path(spark, root, name))


def _refuse_stream_table(spark: SparkSession, root: str, name: str) -> None:
    if is_stream_table(spark, root, name):
        raise ValueError(f"{name} is written by an append stream, whose log hides other rows")


def _refuse_unknown(columns: Iterable[str], known: Iterable[str]) -> None:
    unknown = set(columns) - set(known)
    if unknown:
        raise ValueError(f"no such columns in the table: {sorted(unknown)}")


def append_row(
    spark: SparkSession, root: str, name: str, row: Mapping[str, object], schema: str
) -> str:
    """Add one row and return its id. Meant for single documents; rows belong in
    ``append``."""
    row_id = str(uuid.uuid4())
    values = T.StructType.fromDDL(schema).names
    one = spark.createDataFrame([tuple(row.get(c) for c in values)], schema)
    append(one.withColumn("_id", F.lit(row_id)), root, name)
    return row_id


def replace(df: DataFrame, root: str, name: str, make: bool = False) -> bool:
    """Make ``df`` the whole table. Empty results are skipped: the previous rows
    stay and False is returned. With ``make``, a table that was not written yet is
    made empty. The frame is computed once."""
    version = stage(df, root, name, make)
    if version is None:
        return False
    _publish(df.sparkSession, root, name, version)
    return True


def stage(df: DataFrame, root: str, name: str, make: bool = False) -> str | None:
    """Write ``df`` as a version of a table that no reader sees yet, and return the version,
    to be published by a snapshot. Empty results as in ``replace``: None is returned."""
    spark, version, seen = df.sparkSession, _new_version(), Observation()
    _refuse_stream_table(spark, root, name)
    path = f"{root}/{name}/{version}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    if seen.get["rows"] == 0 and not (make and not exists(spark, root, name)):
        files.delete(spark, path)
        return None
    return version


def upsert(
    updates: DataFrame,
    root: str,
    name: str,
    keys: list[str],
    insert: bool = False,
) -> dict[str, int]:
    """Update the rows of a table that match ``updates`` on ``keys``.

    Returns how many rows matched, changed and were inserted. Keys must be unique
    in ``updates``; a null key matches null and a null value overwrites. With
    ``insert`` a table that does not exist yet is made of the updates.

    The updates are read several times: pass a table, not a long computation. The
    whole table is rewritten; for few changes to a large one see ``merge_into``.
    """
    spark = updates.sparkSession
    repeated = updates.groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"updates hold several rows for one key of {keys}")
    if insert and not exists(spark, root, name):
        target = updates.where(F.lit(False))
    else:
        target = table(spark, root, name)
    return _write_merged(merge_rows(target, updates, keys, insert), root, name)


def upsert_dated(updates: DataFrame, root: str, name: str, keys: list[str], time_col: str) -> None:
    """Update and insert by key in a table laid out by the date of ``time_col``, which
    must be among the keys. Only touched dates are written, and no date beyond the first
    and last of them is read.

    ``updates`` must hold each key once and have the table's columns; it is read several
    times. A repeated call changes nothing. Touched dates are replaced one after the
    other, by Spark's partition overwrite: a reader that is on one of them may fail and
    must read again. ``DATE`` is a column of the table.
    """
    spark = updates.sparkSession
    if _current(spark, root, name) is not None or is_stream_table(spark, root, name):
        raise ValueError(f"{name} is not laid out by date")
    dated = updates.withColumn(DATE, F.to_date(time_col))
    days = F.struct(F.min(DATE).alias("low"), F.max(DATE).alias("high"), F.collect_set(DATE).alias("each"))
    touched = dated.agg(days).scalar()
    near = F.col(DATE).between(touched.low, touched.high)
    target = find(spark, root, name, near & F.array_contains(touched.each, F.col(DATE)), schema=dated.schema)
    same_key = reduce(and_, (F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in [*keys, DATE]))
    kept = target.alias("old").join(dated.alias("new"), same_key, "left_anti")
    # One file for a date, unless it is a large one: the adaptive plan splits those.
    merged = kept.unionByName(dated).hint("rebalance", F.col(DATE))
    writer = merged.write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(f"{root}/{name}")


def merge_into(
    updates: DataFrame, table_name: str, keys: list[str], insert: bool = False
) -> None:
    """The same upsert on a catalog table whose format supports ``MERGE``: only the
    files that hold changed rows are rewritten, in one transaction."""
    same_key = F.expr(
        " and ".join(f"{table_name}.`{k}` <=> source.`{k}`" for k in keys)
    )
    values = {c: F.col(f"source.{c}") for c in updates.columns if c not in keys}
    merge = updates.alias("source").mergeInto(table_name, same_key)
    merge = merge.whenMatched().update(values)
    if insert:
        every = {c: F.col(f"source.{c}") for c in updates.columns}
        merge = merge.whenNotMatched().insert(every)
    merge.merge()


def update_where(
    spark: SparkSession,
    root: str,
    name: str,
    where: Column | str | Mapping[str, object],
    values: Mapping[str, object],
    insert: bool = False,
    schema: str | T.StructType | None = None,
    first_by: list[str] | None = None,
) -> dict[str, int]:
    """Set columns of all rows that satisfy a condition; returns counts as ``upsert``
    does. Values are constants or expressions of the row. Without a match nothing is
    rewritten; with ``insert`` one row is then added, from a mapping's values and the
    new ones. With a ``schema``, a table that was not written yet counts as empty.

    With ``first_by`` one row is set, the first match in the order of these columns (nulls
    first), which must tell the first two matches apart.
    """
    rows = find(spark, root, name, schema=schema)
    _refuse_unknown(values, rows.columns)
    met = condition(where) if first_by is None else _first(rows, condition(where), first_by)
    if not rows.where(met).isEmpty():
        return _write_merged(update_rows(rows, met, values), root, name)
    if insert:
        given = {**(where if isinstance(where, Mapping) else {}), **values}
        one = spark.range(1).select(
            *(_value(given.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema)
        )
        append(one, root, name)
    return {"matched": 0, "modified": 0, "inserted": int(insert)}


def _first(rows: DataFrame, met: Column, by: list[str]) -> Column:
    """The condition of the first of the rows that satisfy a condition."""
    least = rows.where(met).agg(F.min(F.struct(*by))).first()[0]
    if least is None:
        return met
    own = (F.col(c).eqNullSafe(F.lit(least[c]).cast(rows.schema[c].dataType)) for c in by)
    only = reduce(and_, own, met)
    if rows.where(only).count() > 1:
        raise ValueError(f"several rows are first by {by}")
    return only


MERGE_KINDS = ("untouched", "same", "modified", "inserted")


def merge_rows(
    target: DataFrame, updates: DataFrame, keys: list[str], insert: bool = False
) -> DataFrame:
    """Target rows with updates applied, and ``_merge`` naming what happened.

    The target is the outer side of a left join: small updates are broadcast by
    Spark's own size check and the target is not shuffled at all, and with large
    updates the adaptive skew split can divide a key that many target rows share.
    A full outer join allows neither. New keys are found from the few target keys
    that updates touch.
    """
    _refuse_unknown(updates.columns, target.columns)
    values = [c for c in updates.columns if c not in keys]
    kinds = {f.name: f.dataType for f in target.schema}
    fresh = updates.select(
        *(F.col(k).cast(kinds[k]).alias(f"_key_{k}") for k in keys),
        *(F.col(c).cast(kinds[c]).alias(f"_new_{c}") for c in values),
        F.lit(True).alias("_hit"),
    )
    same_key = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    differs = reduce(
        or_, (~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in values), F.lit(False)
    )
    hit = F.col("_hit").isNotNull()
    merged = target.join(fresh, same_key, "left_outer").select(
        *(
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ),
        F.when(~hit, "untouched").when(differs, "modified").otherwise("same").alias("_merge"),
    )
    if not insert:
        return merged
    touched = target.join(fresh, same_key, "left_semi").select(*keys).distinct()
    inserted = fresh.join(touched, same_key, "left_anti").select(
        *(
            F.col(f"_key_{f.name}").alias(f.name)
            if f.name in keys
            else F.col(f"_new_{f.name}").alias(f.name)
            if f.name in values
            else F.lit(None).cast(kinds[f.name]).alias(f.name)
            for f in target.schema
        ),
        F.lit("inserted").alias("_merge"),
    )
    return merged.unionByName(inserted)


def update_rows(
    rows: DataFrame,
    where: Column | str | Mapping[str, object],
    values: Mapping[str, object],
) -> DataFrame:
    """Rows with columns set where a condition holds, and ``_merge`` as above. No
    shuffle is needed."""
    _refuse_unknown(values, rows.columns)
    hit = F.coalesce(condition(where), F.lit(False))
    fresh = {c: _value(v).cast(rows.schema[c].dataType) for c, v in values.items()}
    differs = reduce(
        or_, (~F.col(c).eqNullSafe(v) for c, v in fresh.items()), F.lit(False)
    )
    return rows.select(
        *(
            F.when(hit, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c)
            for c in rows.columns
        ),
        F.when(~hit, "untouched").when(differs, "modified").otherwise("same").alias("_merge"),
    )


def _value(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _write_merged(merged: DataFrame, root: str, name: str) -> dict[str, int]:
    """Publish merged rows and count what happened to them, in one job."""
    spark, version, seen = merged.sparkSession, _new_version(), Observation()
    counted = merged.observe(
        seen, *(F.count_if(F.col("_merge") == m).alias(m) for m in MERGE_KINDS)
    )
    counted.drop("_merge").write.parquet(f"{root}/{name}/{version}")
    _publish(spark, root, name, version)
    kinds = seen.get
    return {
        "matched": kinds["same"] + kinds["modified"],
        "modified": kinds["modified"],
        "inserted": kinds["inserted"],
    }


# -- documents -------------------------------------------------------------------


def with_lineage(df: DataFrame, batch_id: int, updated_at: Column | None = None) -> DataFrame:
    """Add the batch a row came from and when it was written."""
    now = F.current_timestamp() if updated_at is None else updated_at
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
        "updated_at", now
    )


def to_documents(df: DataFrame) -> DataFrame:
    """Every time column as text to the second, instants in UTC."""
    zoned = {T.TimestampType(): True, T.TimestampNTZType(): False}
    return df.select(
        *(
            utc_text(F.col(f.name), zoned[f.dataType]).alias(f.name)
            if f.dataType in zoned
            else F.col(f.name)
            for f in df.schema
        )
    )


def to_json_documents(df: DataFrame) -> DataFrame:
    """One JSON document per row, null fields included."""
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return to_documents(df).select(whole.alias("document"))


# -- versions --------------------------------------------------------------------


def _new_version() -> str:
    """Names sort by time, so that their order needs no file times."""
    return f"{VERSIONS}/{datetime.now(UTC):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex}"


def expire(spark: SparkSession, root: str, name: str, older_than: timedelta) -> int:
    """Delete what no reader can need that began less than ``older_than`` ago: versions
    that were replaced before then, and rows in place that a version has replaced.
    Returns how many entries went. The current version always stays."""
    base = f"{root}/{name}"
    if snapshots.version_of(spark, root, name) is not None:
        raise ValueError(f"{name} is read by snapshots: expire those")
    current = _read_pointer(spark, base)
    if current is None:
        return 0
    _, place, fs = files.hadoop(spark, f"{base}/{VERSIONS}")
    names = sorted(entry.getPath().getName() for entry in fs.listStatus(place))
    limit = f"{datetime.now(UTC) - older_than:%Y%m%dT%H%M%S.%f}"
    published = current.removeprefix(f"{VERSIONS}/")
    versions = [n for n in names if not n.startswith(".")]
    # A version is replaced when the next one begins at the earliest.
    gone = [n for n, after in zip(versions, versions[1:], strict=False) if after < limit and n < published]
    for n in gone:
        files.delete(spark, f"{base}/{VERSIONS}/{n}")
    in_place = list(_visible(spark, base)) if versions and versions[0] < limit else []
    for entry in in_place:
        fs.delete(entry.getPath(), True)
    return len(gone) + len(in_place)


def _current(spark: SparkSession, root: str, name: str) -> str | None:
    """The version that readers see: the newest snapshot's, else the table's own pointer's."""
    return snapshots.version_of(spark, root, name) or _read_pointer(spark, f"{root}/{name}")


def _read_pointer(spark: SparkSession, base: str) -> str | None:
    text = files.read_text(spark, f"{base}/{POINTER}")
    return None if text is None else text.strip()


def _publish(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Make a written version the current one: by the next snapshot, if they name the table,
    else by its pointer, moved in one rename that must replace the old one at once."""
    if snapshots.version_of(spark, root, name) is not None:
        snapshots.publish(spark, root, {name: version})
        return
    draft = f"{root}/{name}/{version}.pointer"
    files.write_text(spark, draft, version)
    files.move(spark, draft, f"{root}/{name}/{POINTER}", replace=True)
