"""Window counts at several levels of time, so that long ranges read few rows.

``add`` keeps closed windows by the minute and sums them into blocks of hours, days and eight,
64 and 512 days. A range of time is made of the coarsest whole blocks, with finer ones at both
ends: ``total`` reads a number of rows that grows with the logarithm of its length (and, below
512 days, stays under 150 for each key).

Each level is a table of its own, laid out in pages of 1,440 blocks, of which a write touches
those its windows fall in and a read those at the range's ends. Blocks are aligned to the
epoch, so that neither the session's time zone nor the first window matters. One writer; a
reader during ``add`` may find the finer levels ahead of the coarser ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.sources import tables

DAY = 1440
STEPS = (1, 60, DAY, 8 * DAY, 64 * DAY, 512 * DAY)  # minutes; each divides the next
PAGE = 1440  # blocks of one folder


# -- writing ---------------------------------------------------------------------


def add(windows: DataFrame, root: str, name: str, keys: Iterable[str] = (), time_col: str = "window_start") -> None:
    """Keep windows of a minute, one row for each window and key with its ``count``, and bring
    the blocks they fall in up to date. A window that is there already is replaced, so that a
    repeated call changes nothing. Windows without a time are left out. ``windows`` is read
    several times: pass a table, not a long computation.
    """
    spark, keys = windows.sparkSession, list(keys)
    minute = _minutes(F.col(time_col), windows.schema[time_col].dataType)
    rows = windows.select(minute.alias("block"), *keys, F.col("count").cast("bigint").alias("count"))
    rows = rows.where(F.col("block").isNotNull())
    low, high = rows.agg(F.min("block"), F.max("block")).first()
    if low is None:
        return
    _write(rows, root, name, STEPS[0], keys)
    for finer, step in zip(STEPS, STEPS[1:], strict=False):
        touched = rows.select(_start(step).alias("whole")).distinct()
        parts = _read(spark, root, name, finer, rows.schema, [(low - low % step, high - high % step + step)])
        within = parts.withColumn("whole", _start(step)).join(touched, "whole", "left_semi")
        sums = within.groupBy(F.col("whole").alias("block"), *keys).agg(F.sum("count").alias("count"))
        _write(sums.select(*rows.columns), root, name, step, keys)


def adding(root: str, name: str, keys: Iterable[str] = ()) -> Callable[[DataFrame, int], None]:
    """``add`` for the batches of a stream of closed windows (append mode)."""
    keys = list(keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            add(batch, root, name, keys)
        finally:
            batch.unpersist()

    return each


def _minutes(time: Column, kind: T.DataType) -> Column:
    """The minute of a time since the epoch; a time without a zone counts as UTC."""
    if kind == T.TimestampNTZType():
        return (F.unix_date(time.cast("date")) * DAY + F.hour(time) * 60 + F.minute(time)).cast("bigint")
    return F.floor(F.unix_seconds(time) / 60)


def _start(step: int) -> Column:
    """The block of ``step`` minutes that a block lies in."""
    return F.col("block") - F.pmod("block", F.lit(step).cast("bigint"))


def _page(block: int, step: int) -> int:
    """The page of a block, as the day its folder is named after."""
    return block // (step * PAGE) * (step * PAGE // DAY)


def _write(rows: DataFrame, root: str, name: str, step: int, keys: list[str]) -> None:
    whole = F.lit(step * PAGE).cast("bigint")
    day = (F.col("block") - F.pmod("block", whole)) / DAY
    paged = rows.withColumn("page", F.date_from_unix_date(day.cast("int")))
    tables.upsert_dated(paged, root, _table(name, step), ["page", "block", *keys], "page")


def _table(name: str, step: int) -> str:
    return f"{name}_{step}"


# -- reading ---------------------------------------------------------------------


def pieces(since: int, until: int) -> list[tuple[int, int, int]]:
    """The blocks that make up the minutes from ``since`` up to ``until``: the step, and the
    first minute and the end of each run of them, at most two runs for a step."""
    runs = []
    for step, above in zip(STEPS, [*STEPS[1:], None], strict=True):
        inner = (-(-since // above) * above, until // above * above) if above else (until, since)
        if inner[0] >= inner[1]:
            return runs + [(step, since, until)] * (since < until)
        runs += [(step, since, inner[0])] * (since < inner[0])
        runs += [(step, inner[1], until)] * (inner[1] < until)
        since, until = inner
    return runs


def blocks(since: int, until: int) -> int:
    """How many rows of each key a range reads at most."""
    return sum((end - first) // step for step, first, end in pieces(since, until))


def total(
    spark: SparkSession, root: str, name: str, since: datetime, until: datetime, keys: Iterable[str] = ()
) -> DataFrame:
    """The count of all windows that start from ``since`` up to, but not at, ``until``; for
    each of the keys, if any are named. Times without a zone are UTC. No windows give no rows,
    or without keys a count of null."""
    keys, schema = list(keys), _schema(spark, root, name)
    runs = pieces(_minute(since), _minute(until))
    by_step = {step: [r[1:] for r in runs if r[0] == step] for step, *_ in runs}
    parts = [_read(spark, root, name, step, schema, own) for step, own in by_step.items()]
    parts = parts or [spark.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("count").alias("count"))


def series(
    spark: SparkSession, root: str, name: str, step: int, since: datetime, until: datetime
) -> DataFrame:
    """The blocks of a level that start in a range, as windows with their counts."""
    if step not in STEPS:
        raise ValueError(f"levels have steps of {STEPS} minutes, not {step}")
    schema = _schema(spark, root, name)
    rows = _read(spark, root, name, step, schema, [(_minute(since), _minute(until))])
    edges = [F.timestamp_seconds((F.col("block") + more) * 60) for more in (0, step)]
    return rows.select(edges[0].alias("window_start"), edges[1].alias("window_end"), *schema.names[1:])


def _schema(spark: SparkSession, root: str, name: str) -> T.StructType:
    kept = tables.table(spark, root, _table(name, STEPS[0])).drop("page", tables.DATE).schema
    return T.StructType([kept["block"], *(f for f in kept if f.name != "block")])


def _read(
    spark: SparkSession, root: str, name: str, step: int, schema: T.StructType, runs: list[tuple[int, int]]
) -> DataFrame:
    """Blocks of a level that start in one of some runs of minutes; other pages are not read."""
    stored = T.StructType([*schema, T.StructField("page", T.DateType()), T.StructField(tables.DATE, T.DateType())])
    met = (_within(first, end, step) for first, end in runs)
    return tables.find(spark, root, _table(name, step), reduce(or_, met), schema.names, schema=stored)


def _within(first: int, end: int, step: int) -> Column:
    days = [F.date_from_unix_date(F.lit(_page(block, step))) for block in (first, end - 1)]
    return F.col(tables.DATE).between(*days) & (F.col("block") >= first) & (F.col("block") < end)


def _minute(time: datetime) -> int:
    """The first whole minute at or after a time."""
    known = time if time.tzinfo else time.replace(tzinfo=UTC)
    since = known - datetime(1970, 1, 1, tzinfo=UTC)
    return -(-(since.days * 86_400_000_000 + since.seconds * 1_000_000 + since.microseconds) // 60_000_000)
