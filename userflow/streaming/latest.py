"""The newest record of each user, kept by a stream.

A user's state is the newest record by its own time, and a timer that clears it when the
watermark has passed that time by ``idle``. A record behind the watermark is refused, so that
one that comes after its user's state was cleared is always newer than what was there. Tasks
leave out records that a newer one of the same user beats before the shuffle, so that the state
sees few of a user with many. What
changes in a micro-batch is upserted into a table in hash buckets of the user's key, of which
only the touched ones are read and written; rows of idle users stay there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from userflow.sources import buckets, snapshots
from userflow.streaming.pipeline import EVERY, BatchSink, _shuffle_partitions

NAME = "latest_users"
BUCKETS = 64
STATE_PARTITIONS = 64
COMBINED = 1 << 15  # newest rows that a task holds before it gives them on
# Kinds of keys whose equal values are neighbours when sorted.
_SORTED = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Helper columns: a record's time in microseconds, and a digest that parts equal times.
MICROS, TIE = "_micros", "_tie"


def _ordered(users: DataFrame, key: str, time_col: str) -> DataFrame:
    """Users that have a key and a time, with what orders their records."""
    there = users.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    return there.withColumns({MICROS: F.unix_micros(time_col), TIE: F.xxhash64(*users.columns)})


def latest_users(users: DataFrame, key: str = "id", time_col: str = "timestamp") -> DataFrame:
    """The newest row of each key, of a batch: of equal times the one of the greater digest.
    Rows without a key or a time are left out. Newest rows are found before the shuffle, so
    that a key with a third of all rows sends one per task."""
    every = F.struct(*users.columns)
    newest = F.max_by(every, F.struct(MICROS, TIE)).alias("row")
    return _ordered(users, key, time_col).groupBy(key).agg(newest).select("row.*")


def _newest_rows(rows: pa.Table, key: str) -> pa.Table:
    order = pc.sort_indices(rows, [(key, "ascending"), (MICROS, "descending"), (TIE, "descending")])
    keys = pc.take(rows[key], order).combine_chunks()
    first = pa.concat_arrays([pa.array([True]), pc.not_equal(keys[1:], keys[:-1])])
    return rows.take(order.filter(first))


def _without_beaten(ordered: DataFrame, key: str) -> DataFrame:
    """The rows without such as a newer one of their key beats within a task: all that are the
    newest of their key stay. A key of another kind than those that sort is left as it is."""
    if not isinstance(ordered.schema[key].dataType, _SORTED) or "variant" in ordered.schema.simpleString():
        return ordered

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = _newest_rows(pa.Table.from_batches([batch]), key)
            held = fresh if held is None else _newest_rows(pa.concat_tables([held, fresh]), key)
            if held.num_rows > COMBINED:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return ordered.mapInArrow(combined, ordered.schema)


class Newest(StatefulProcessor):
    """Keeps the newest row of a key, and gives it out when it changes."""

    def __init__(self, schema: T.StructType, idle_ms: int):
        self.schema, self.idle_ms = schema, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("newest", T.StructType([T.StructField(MICROS, T.LongType()), T.StructField(TIE, T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: (r[MICROS], r[TIE]))
        before = self.held.get() if self.held.exists() else None
        if before is not None:
            if (before[0], before[1]) >= (newest[MICROS], newest[TIE]):
                return
            self.handle.deleteTimer(self._ends(before[0]))
        self.held.update((newest[MICROS], newest[TIE]))
        self.handle.registerTimer(self._ends(newest[MICROS]))
        yield Row(**{f.name: newest[f.name] for f in self.schema})

    def _ends(self, micros: int) -> int:
        return micros // 1000 + self.idle_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_latest(
    users: DataFrame, key: str = "id", time_col: str = "timestamp", idle: str = "30 days", watermark: str = "1 hour"
) -> DataFrame:
    """The newest row of each key, each time that it changes, out of a stream. The state holds
    two numbers for each key that had a record within ``idle`` of the watermark."""
    idle_ms = users.sparkSession.range(1).select(_millis(idle)).first()[0]
    timed = _without_beaten(_ordered(users, key, time_col), key).withWatermark(time_col, watermark)
    return timed.groupBy(key).transformWithState(
        statefulProcessor=Newest(users.schema, idle_ms), outputStructType=users.schema, outputMode="update", timeMode="eventtime"
    )


def _millis(interval: str) -> Column:
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, epoch + F.expr(f"interval {interval}"))


def into_buckets(spark: SparkSession, root: str, name: str, key: str, count: int = BUCKETS) -> BatchSink:
    """A sink that upserts each batch, which holds each key once, into a table in buckets. The
    batch is written once and merged from there; a replayed batch merges to the same rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{root}/{name}_changes"
        batch.write.mode("overwrite").parquet(staged)
        changes = spark.read.schema(batch.schema).parquet(staged)
        if snapshots.latest(spark, f"{root}/{name}") is None:
            buckets.create(changes, root, name, [key], count)
        else:
            buckets.upsert(changes, root, name)

    return write


def start_latest(
    users: DataFrame, root: str, checkpoint: str, name: str = NAME, key: str = "id", time_col: str = "timestamp",
    idle: str = "30 days", watermark: str = "1 hour", every: str | None = EVERY, count: int = BUCKETS,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """Start keeping the newest row of each key in the bucketed table ``name``; without
    ``every`` the query handles what is there and ends. The numbers of buckets and of state
    partitions are fixed at the first start. Needs the RocksDB state store, which is set for
    this query."""
    spark = users.sparkSession
    writer = (
        stream_latest(users, key, time_col, idle, watermark)
        .writeStream.outputMode("update")
        .queryName(name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    with _shuffle_partitions(spark, state_partitions), _state_store(spark):
        return writer.foreachBatch(into_buckets(spark, root, name, key, count)).start()


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """A query takes its settings from the session at the moment it starts."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)
