"""Inflow that keeps late rows.

Spark's own window aggregation drops the rows behind its watermark; only their number is
seen. Here a micro-batch is counted into open windows, windows behind the watermark are
closed into a table laid out by date, and rows that come for a closed window are kept in a
side table, with the watermark that refused them, and counted into their window. The
watermark is the newest time of earlier batches less the delay: a window refuses rows from the
batch on that finds it closed. (Spark goes by the watermark of the batch before that.)

What a batch needs from the ones before, the open windows and the newest time, is one
snapshot, so that a batch is finished by one move. A batch that is run again, wherever it was
cut off, gives the same tables: late rows are written per batch, closed windows carry the
batch that touched them last, and a finished batch is not run at all.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from userflow.sources import snapshots, tables
from userflow.streaming.pipeline import EVERY, BatchSink

NAME = "user_inflow"
KEYS = ["window_start", "window_end"]
CLOSED = "window_start timestamp, window_end timestamp, count bigint, late bigint, batch_id bigint, updated_at timestamp"
OPEN = "window_start timestamp, window_end timestamp, count bigint, newest bigint"
# Finished batches after which old snapshots of the open windows are cleared away.
CLEAR_EVERY, CLEAR_AFTER = 100, timedelta(hours=1)


def _state(root: str, name: str) -> str:
    return f"{root}/{name}_state"


def _micros(interval: str) -> Column:
    """An interval of days or less, in microseconds."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, epoch + F.expr(f"interval {interval}"))


def keeping_late(
    spark: SparkSession, root: str, name: str = NAME, time_col: str = "timestamp", window: str = "1 minute", delay: str = "1 minute"
) -> BatchSink:
    """A sink that counts batches into windows and keeps what comes late. Rows without a time
    are in no window, and not late."""
    state = _state(root, name)
    waits = spark.range(1).select(_micros(delay)).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = snapshots.latest(spark, state)
        if before is not None and before.batch_id >= batch_id:
            return  # finished, and run again
        newest = before.info["newest"] if before else None
        closed_by = F.lit(None if newest is None else newest - waits).cast("bigint")
        span = F.window(time_col, window)
        placed = batch.where(F.col(time_col).isNotNull()).withColumns({"window_start": span["start"], "window_end": span["end"]})
        is_late = F.coalesce(F.unix_micros("window_end") <= closed_by, F.lit(False))
        # Read for the late rows and for the others; an executor that is lost reads its part again.
        placed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            refused = placed.where(is_late).withColumn("watermark", F.timestamp_micros(closed_by))
            some_late = not refused.isEmpty()
            if some_late:
                refused.write.mode("overwrite").parquet(f"{root}/{name}_late/batch_id={batch_id}")
            counted = placed.where(~is_late).groupBy(*KEYS).agg(F.count("*").alias("count"), F.max(F.unix_micros(time_col)).alias("newest"))
            every = counted if before is None else counted.unionByName(before.table(spark, "open", OPEN))
            summed = every.groupBy(*KEYS).agg(F.sum("count").alias("count"), F.max("newest").alias("newest"))
            whole = _written(summed, state, "windows")
        finally:
            placed.unpersist()
        held = whole.agg(F.max("newest")).first()[0]
        newest = max((t for t in (newest, held) if t is not None), default=None)
        shut = F.lit(False) if newest is None else F.unix_micros("window_end") <= F.lit(newest - waits)
        added = whole.where(shut).select(*KEYS, "count", F.lit(0).cast("bigint").alias("late"))
        if some_late:
            again = spark.read.parquet(f"{root}/{name}_late/batch_id={batch_id}")
            n = F.count("*")
            added = added.unionByName(again.groupBy(*KEYS).agg(n.alias("count"), n.alias("late")))
        _close(spark, added, root, name, batch_id)
        versions = {"open": tables.stage(whole.where(~shut), state, "open", make=True)}
        if versions["open"] is None:  # no window is open now
            versions["open"] = _empty(spark, state)
        snapshots.publish(spark, state, versions, batch_id, {"newest": newest})
        if batch_id % CLEAR_EVERY == 0:
            snapshots.expire(spark, state, CLEAR_AFTER)
            tables.expire(spark, state, "windows", CLEAR_AFTER)
            tables.expire(spark, state, "changes", CLEAR_AFTER)

    return write


def _written(rows: DataFrame, root: str, name: str) -> DataFrame:
    tables.replace(rows, root, name, make=True)
    path = tables.table_path(rows.sparkSession, root, name)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _empty(spark: SparkSession, state: str) -> str:
    version = f"{tables.VERSIONS}/none"
    spark.createDataFrame([], OPEN).write.mode("overwrite").parquet(f"{state}/open/{version}")
    return version


def _close(spark: SparkSession, added: DataFrame, root: str, name: str, batch_id: int) -> None:
    """Count ``added`` (window, count, late) into the closed windows, once for each batch."""
    added = added.select(*KEYS, F.col("count").alias("more"), F.col("late").alias("more_late"))
    edges = added.agg(F.min("window_start").alias("low"), F.max("window_start").alias("high")).first()
    if edges.low is None:
        return
    days = F.col(tables.DATE).between(F.to_date(F.lit(edges.low)), F.to_date(F.lit(edges.high)))
    old = tables.find(spark, root, name, days, schema=f"{CLOSED}, {tables.DATE} date").drop(tables.DATE, "updated_at")
    both = added.join(old, KEYS, "left").where(F.coalesce(F.col("batch_id") < batch_id, F.lit(True)))
    changed = both.select(
        *KEYS,
        *((F.coalesce(c, F.lit(0)) + F.col(more)).alias(c) for c, more in (("count", "more"), ("late", "more_late"))),
    )
    if tables.replace(tables.with_lineage(changed, batch_id), _state(root, name), "changes"):
        tables.upsert_dated(tables.table(spark, _state(root, name), "changes"), root, name, KEYS, "window_start")


def start_inflow(
    users: DataFrame, root: str, checkpoint: str, name: str = NAME, every: str | None = EVERY, **windows
) -> StreamingQuery:
    """Start counting a stream with a time column; without ``every`` it handles what is there
    and ends. ``windows`` are the options of ``keeping_late``."""
    writer = users.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.foreachBatch(keeping_late(users.sparkSession, root, name, **windows)).start()


def closed(spark: SparkSession, root: str, name: str = NAME) -> DataFrame:
    """Closed windows with all their rows so far: window_start, window_end, count, and late,
    how many of them came late."""
    return tables.find(spark, root, name, schema=f"{CLOSED}, {tables.DATE} date").select(*KEYS, "count", "late")


def late_rows(spark: SparkSession, root: str, name: str = NAME) -> DataFrame:
    """The rows that came late, with their window, the watermark and the batch."""
    return spark.read.parquet(f"{root}/{name}_late")


def open_windows(spark: SparkSession, root: str, name: str = NAME) -> DataFrame:
    """Windows that are not closed yet: window_start, window_end, count."""
    newest = snapshots.latest(spark, _state(root, name))
    rows = spark.createDataFrame([], OPEN) if newest is None else newest.table(spark, "open", OPEN)
    return rows.select(*KEYS, "count")


def inflow(spark: SparkSession, root: str, name: str = NAME) -> DataFrame:
    """All windows, closed and open: window_start, window_end, count. While a batch is written,
    a window that it closes may be in both; it is then taken as closed."""
    shut = closed(spark, root, name).select(*KEYS, "count")
    still = open_windows(spark, root, name).join(shut.select(*KEYS), KEYS, "left_anti")
    return shut.unionByName(still)
