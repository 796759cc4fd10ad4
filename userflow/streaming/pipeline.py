"""Running the analytics as Structured Streaming queries.

Output modes and their sinks:

* ``complete`` (default): every trigger replaces the whole result table. The
  watermark neither drops late rows nor frees state here.
* ``update``: changed rows are upserted into the result table by key; results that grow
  with time are laid out by date, and only touched dates are written.
* ``append``: final rows only, so closed windows of inflow, or age counts of past
  batches; Spark's file sink adds them exactly once. Such a table belongs to its stream:
  readers go by the sink's log. A stream does not append to a table that has versions,
  and nothing else writes to the table of such a stream: both raise an error.

Each query has its own checkpoint, so a restart resumes its counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from userflow.operators import analytics
from userflow.operators.parse import ARRIVED, parse_users, stamp, with_event_time
from userflow.schema import LANDED_FIELDS, RESULT_KEYS, ddl
from userflow.sources import snapshots, tables

EVERY = "10 seconds"
LAND_EVERY = "1 minute"
STATE_PARTITIONS = 8

RESULTS = tuple(analytics.NEEDS)
# What identifies an age count that is kept per micro-batch.
BATCH_KEYS = ["age_group", "timestamp"]
# What inflow counts by: the clock, the topic's time of a message, the record's own.
INFLOW_TIMES = ("processing", "arrival", "record")


# -- results of a topic ----------------------------------------------------------


def topic_results(
    messages: DataFrame,
    parse: str = "normalized",
    skip_bad: bool = False,
    per_batch: bool = False,
    inflow_by: str = "processing",
    window: str = "1 minute",
    watermark: str | None = "1 minute",
    as_of: Column | None = None,
    unknown_label: str | None = None,
) -> dict[str, DataFrame]:
    """The five results of a topic; each decodes only the fields it uses.

    Inflow counts by processing time, by ``arrival`` (the topic's own time of a
    message, which needs no decoding and survives a replay) or by the time in the
    ``record``, which is bounded by the arrival. ``per_batch`` keys the age counts by
    micro-batch. The watermark applies to both.
    """
    now = F.current_timestamp() if as_of is None else as_of

    def users(name: str) -> DataFrame:
        by = inflow_by if name == "user_inflow" else "processing"
        return _timed_users(messages, parse, analytics.NEEDS[name], skip_bad, by, as_of)

    inflow_time = _inflow_column(inflow_by)
    return {
        "gender_distribution": analytics.gender_distribution(
            users("gender_distribution"), now
        ),
        "age_distribution": analytics.age_distribution(
            users("age_distribution"), per_batch, unknown_label=unknown_label,
            watermark=watermark, as_of=now,
        ),
        "country_distribution": analytics.country_distribution(
            users("country_distribution"), now
        ),
        "user_inflow": analytics.user_inflow(
            users("user_inflow"), inflow_time, window, watermark, now
        ),
        "avg_age_by_country": analytics.avg_age_by_country(
            users("avg_age_by_country"), now
        ),
    }


def _inflow_column(inflow_by: str) -> str:
    if inflow_by not in INFLOW_TIMES:
        raise ValueError(f"inflow is by one of {INFLOW_TIMES}, not {inflow_by!r}")
    return {"processing": "processed_timestamp", "arrival": ARRIVED, "record": "timestamp"}[inflow_by]


def _timed_users(
    messages: DataFrame,
    parse: str,
    fields: tuple[str, ...],
    skip_bad: bool,
    inflow_by: str,
    as_of: Column | None,
) -> DataFrame:
    """Parsed users with the time column that their inflow needs."""
    record = inflow_by == "record"
    # Without a topic's time the clock stands for the arrival.
    topic_time = inflow_by == "arrival" or record and "timestamp" in messages.columns
    wanted = (*fields, "timestamp") if record else fields
    users = parse_users(messages, parse, wanted, skip_bad, topic_time)
    if record:
        now = F.current_timestamp() if as_of is None else as_of
        users = with_event_time(users, arrived=F.col(ARRIVED) if topic_time else now)
    return stamp(users, as_of)


# -- sinks -----------------------------------------------------------------------

BatchSink = Callable[[DataFrame, int], None]


def replacing(root: str, name: str) -> BatchSink:
    """Each non-empty batch becomes the whole table, with its lineage."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.replace(tables.with_lineage(batch, batch_id), root, name)

    return write


def upserting(spark: SparkSession, root: str, name: str, keys: list[str]) -> BatchSink:
    """Rows of each batch replace the rows with the same key.

    The batch is written once and merged from there: running its plan again would
    read and commit the state store again. The merge runs in the given session,
    because a stream's own session has adaptive execution switched off. A replayed
    batch merges to the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{name}_changes"
        if not tables.replace(tables.with_lineage(batch, batch_id), root, staged):
            return
        changes = tables.table(spark, root, staged)
        tables.upsert(changes, root, name, keys, insert=True)

    return write


def upserting_dated(
    spark: SparkSession, root: str, name: str, keys: list[str], time_col: str
) -> BatchSink:
    """The same for a table that is laid out by date: rows of other dates are neither
    read nor written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{name}_changes"
        if tables.replace(tables.with_lineage(batch, batch_id), root, staged):
            changes = tables.table(spark, root, staged)
            tables.upsert_dated(changes, root, name, keys, time_col)

    return write


def splitting(
    spark: SparkSession, root: str, names: Iterable[str] = RESULTS
) -> BatchSink:
    """Each batch of the combined result replaces the tables of all its results.

    The batch is written once; the tables are made from what was written, by small
    jobs side by side, and published by one snapshot: all of them move on at once, with
    ``combined``. A result without rows makes an empty table at first and later leaves
    the previous rows.
    """
    names = tuple(names)

    def write(batch: DataFrame, batch_id: int) -> None:
        whole = tables.stage(tables.with_lineage(batch, batch_id), root, "combined", make=True)
        if whole is None:
            return
        combined = spark.read.parquet(f"{root}/combined/{whole}")

        def stage(name: str) -> str | None:
            return tables.stage(analytics.pick_result(combined, name), root, name, make=True)

        # Jobs of the pool belong to the query, so that stopping it stops them.
        with ThreadPoolExecutor(len(names)) as pool:
            staged = list(pool.map(inheritable_thread_target(spark)(stage), names))
        versions = {name: version for name, version in zip(names, staged, strict=True) if version}
        snapshots.publish(spark, root, {"combined": whole, **versions}, batch_id)

    return write


# What a result that grows with time is laid out by.
TIMES = {"user_inflow": "window_start", "age_distribution": "timestamp"}


# -- queries ---------------------------------------------------------------------


def start_result(
    result: DataFrame,
    root: str,
    name: str,
    checkpoint: str,
    mode: str = "complete",
    every: str | None = EVERY,
    keys: list[str] | None = None,
    sink: BatchSink | None = None,
    state_partitions: int = STATE_PARTITIONS,
) -> StreamingQuery:
    """Start one query; without ``every`` it handles what is there and ends.

    The number of state partitions is fixed in the checkpoint at the first start.
    Results have few keys and rows are combined before the shuffle, so it is small;
    raise it for results with many keys.
    """
    writer = (
        result.writeStream.outputMode(mode)
        .queryName(name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
    )
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    if mode == "append" and sink is None:
        spark = result.sparkSession
        if tables.exists(spark, root, name) and not tables.is_stream_table(spark, root, name):
            raise ValueError(f"{name} holds rows that no append stream wrote, which would hide its own")
        writer = writer.format("parquet").option("path", f"{root}/{name}")
    else:
        if sink is None and mode == "update":
            own = keys or RESULT_KEYS[name]
            if TIMES.get(name) in own:
                sink = upserting_dated(result.sparkSession, root, name, own, TIMES[name])
            else:
                sink = upserting(result.sparkSession, root, name, own)
        writer = writer.foreachBatch(sink or replacing(root, name))
    with _shuffle_partitions(result.sparkSession, state_partitions):
        return writer.start()


def start_all(
    results: dict[str, DataFrame],
    root: str,
    checkpoint: str,
    mode: str | Mapping[str, str] = "complete",
    every: str | None = EVERY,
    keys: Mapping[str, list[str]] | None = None,
    sinks: Mapping[str, BatchSink] | None = None,
    state_partitions: int = STATE_PARTITIONS,
) -> list[StreamingQuery]:
    """Start one query per result and hand back all of them, or none if one cannot
    start. ``mode`` is one for all, or a mapping by name; complete where unnamed."""
    modes = mode if isinstance(mode, Mapping) else dict.fromkeys(results, mode)
    started: list[StreamingQuery] = []
    try:
        for name, result in results.items():
            started.append(
                start_result(
                    result, root, name, checkpoint, modes.get(name, "complete"), every,
                    keys=(keys or {}).get(name), sink=(sinks or {}).get(name),
                    state_partitions=state_partitions,
                )
            )
    except Exception:
        for query in started:
            query.stop()
        raise
    return started


def run_pipeline(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    mode: str | Mapping[str, str] = "complete",
    every: str | None = EVERY,
    shared_scan: bool = False,
    state_partitions: int = STATE_PARTITIONS,
    **parsing,
) -> list[StreamingQuery]:
    """Topic to result tables: read, parse, aggregate, write. Returns the queries.

    Five queries scan the topic five times and advance on their own. With
    ``shared_scan`` one query scans and parses it once and writes all tables from one
    batch; they move on together, by one snapshot for each batch.

    ``mode="bounded"`` appends what becomes final, so that watermarks free the state
    that would grow for ever (inflow windows, age counts per batch), and keeps the
    other results, which have few keys, in complete mode. With a shared scan, inflow
    is then a second query, which decodes no more than a time.
    """
    spark, bounded = messages.sparkSession, mode == "bounded"
    per_batch = parsing.get("per_batch", False)
    if mode == "append":
        raise ValueError("not all results have rows that become final: use 'bounded'")
    if not shared_scan:
        results = topic_results(messages, **parsing)
        growing = ["user_inflow", "age_distribution"] if per_batch else ["user_inflow"]
        modes = dict.fromkeys(growing, "append") if bounded else mode
        keys = {"age_distribution": BATCH_KEYS} if per_batch else None
        return start_all(
            results, root, checkpoint, modes, every, keys, state_partitions=state_partitions
        )
    if per_batch or (mode != "complete" and not bounded):
        raise ValueError("a shared scan replaces whole tables of totals")
    if parsing.get("window", "1 minute") != "1 minute" and not bounded:
        raise ValueError("a shared scan counts inflow per minute")
    shared = {k: parsing[k] for k in ("parse", "skip_bad", "as_of", "unknown_label") if k in parsing}
    if bounded:
        results = {
            "combined": combined_results(messages, windows=False, **shared),
            "user_inflow": topic_results(messages, **parsing)["user_inflow"],
        }
        names = [name for name in RESULTS if name != "user_inflow"]
    else:
        inflow_by = parsing.get("inflow_by", "processing")
        combined = combined_results(messages, inflow_by=inflow_by, **shared)
        results, names = {"combined": combined}, RESULTS
    return start_all(
        results, root, checkpoint, {"user_inflow": "append"}, every,
        sinks={"combined": splitting(spark, root, names)}, state_partitions=state_partitions,
    )


def backfill(
    messages: DataFrame, root: str, batch_id: int = 0, inflow_by: str = "arrival", **parsing
) -> None:
    """The same five tables from a batch of messages, read and parsed once. Inflow is by
    the topic's own time, since the clock would put all of a replay into one window."""
    combined = combined_results(messages, inflow_by=inflow_by, **parsing)
    splitting(messages.sparkSession, root)(combined, batch_id)


def combined_results(
    messages: DataFrame,
    parse: str = "normalized",
    skip_bad: bool = False,
    inflow_by: str = "processing",
    windows: bool = True,
    as_of: Column | None = None,
    unknown_label: str | None = None,
) -> DataFrame:
    """All results of a topic from one scan and one parse; without ``windows`` all but
    the inflow."""
    time_col = _inflow_column(inflow_by)
    fields = ("gender", "age", "country")
    users = _timed_users(messages, parse, fields, skip_bad, inflow_by if windows else "processing", as_of)
    now = F.current_timestamp() if as_of is None else as_of
    combined = analytics.analytics_in_one_pass(users, time_col if windows else None, unknown_label)
    return combined.withColumn("timestamp", now)


# -- a parsed table in between ---------------------------------------------------


def land_users(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = LAND_EVERY,
    parse: str = "normalized",
    skip_bad: bool = False,
    files: int | None = None,
) -> StreamingQuery:
    """Parse the topic once into a columnar table that later queries stream from.

    Rows keep their arrival time and are laid out by arrival date. Each batch adds at
    least a file for each of its tasks; ``files`` deals its rows to so many, at the price
    of a shuffle, and a longer ``every`` makes fewer batches. ``archive_dates`` puts
    closed dates into few files.
    """
    users = stamp(parse_users(messages, parse, skip_bad=skip_bad))
    dated = users.withColumn("arrival_date", F.to_date("processed_timestamp"))
    if files is not None:
        dated = dated.repartition(files)
    writer = (
        dated.writeStream.format("parquet")
        .partitionBy("arrival_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def archive_dates(
    spark: SparkSession, path: str, archive: str, before: str, files_per_date: int = 1
) -> None:
    """Copy the landed rows of all dates before ``before`` into a table of its own, with
    few files for each date. Streams go on reading ``path``, batch jobs read closed dates
    from ``archive``. Dates that are there already are written anew, so a repeated call
    changes nothing; pass a later landing folder, or let the landing stream's file
    ``retention`` go, to drop what is archived."""
    closed = spark.read.parquet(path).where(F.col("arrival_date") < F.lit(before).cast("date"))
    piece = F.pmod(F.xxhash64("id", "processed_timestamp"), F.lit(files_per_date))
    dates = closed.repartition("arrival_date", piece)
    writer = dates.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("arrival_date").parquet(archive)


def stream_users(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of a table written by ``land_users``."""
    reader = spark.readStream.schema(ddl(LANDED_FIELDS))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


# -- waiting ---------------------------------------------------------------------


def wait_for(queries: Iterable[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until all queries end. When one fails, stop the rest and raise."""
    queries = list(queries)
    try:
        while True:
            running = [q for q in queries if q.isActive]
            for query in queries:
                if not query.isActive and query.exception() is not None:
                    raise query.exception()
            if not running:
                return
            running[0].awaitTermination(poll_seconds)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


@contextmanager
def _shuffle_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """A query takes its settings from the session at the moment it starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, count)
    try:
        yield
    finally:
        spark.conf.set(key, before)
