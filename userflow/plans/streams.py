"""Streaming queries over the test tables.

Messages are landed as topic files in the shared scratch folder in two steps. The
stream runs after each step, the second time from its checkpoint, and the result
tables are read back.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.times import MICROS, wall_clock
from userflow.operators import analytics, frequent, views
from userflow.operators.parse import parse_users, with_event_time
from userflow.plans.users import (
    arrived_messages,
    flat_columns,
    land_in_two,
    raw_columns,
    raw_records,
    spread_series,
    user_messages,
    user_records,
)
from userflow.session import scratch
from userflow.sources import buckets, levels, snapshots, tables, topic
from userflow.streaming import late, latest, pipeline, sketches

NTZ = "timestamp_ntz"


def _run(spark: SparkSession, sf_dir: str, start, rows=None, late=None) -> str:
    """Call ``start(messages, root, checkpoint)`` after each landing; the queries it
    starts run to the end of what is there. Returns the root of the result tables."""
    base = scratch(spark, "stream")
    root, checkpoint = f"{base}/tables", f"{base}/checkpoints"
    for landed in land_in_two(spark, sf_dir, f"{base}/topic", rows, late):
        pipeline.wait_for(start(topic.stream_topic_files(spark, landed), root, checkpoint))
    return root


def _one(name: str, mode: str = "complete", **parsing):
    """Start the named result only."""

    def start(messages: DataFrame, root: str, checkpoint: str):
        results = pipeline.topic_results(messages, **{"inflow_by": "record", **parsing})
        return [
            pipeline.start_result(results[name], root, name, checkpoint, mode, every=None)
        ]

    return start


def _windows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("window_start").cast(NTZ).alias("window_start"),
        F.col("window_end").cast(NTZ).alias("window_end"),
        "count",
    )


def stream_avg_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(spark, sf_dir, _one("avg_age_by_country"))
    return tables.find(
        spark, root, "avg_age_by_country", columns=["country", "avg_age", "count"]
    )


def stream_gender_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Started by the clock, as in service, and stopped when all is counted."""

    def start(messages: DataFrame, root: str, checkpoint: str):
        result = pipeline.topic_results(messages)["gender_distribution"]
        query = pipeline.start_result(
            result, root, "gender_distribution", checkpoint, every="1 second"
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return [query]

    root = _run(spark, sf_dir, start)
    return tables.find(spark, root, "gender_distribution", columns=["gender", "count"])


def stream_inflow_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(spark, sf_dir, _one("user_inflow"))
    return _windows(tables.table(spark, root, "user_inflow"))


def stream_inflow_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(spark, sf_dir, _one("user_inflow", "append"))
    return _windows(tables.table(spark, root, "user_inflow"))


def stream_inflow_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(spark, sf_dir, _one("user_inflow", "update"))
    return _windows(tables.table(spark, root, "user_inflow"))


def stream_inflow_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the topic's own times, without decoding any record."""

    def rows(users: DataFrame) -> DataFrame:
        return arrived_messages(users, flat_columns())

    root = _run(spark, sf_dir, _one("user_inflow", inflow_by="arrival"), rows)
    return _windows(tables.table(spark, root, "user_inflow"))


def stream_inflow_untrusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final windows of records of which some carry a time far ahead, and some come too
    late: the former count at their arrival, the latter not at all."""
    number = F.substring("id", 3, 20).cast("bigint")

    def rows(users: DataFrame) -> DataFrame:
        told = F.when(number % 13 == 0, "2999-12-31T00:00:00").otherwise(F.date_format("ts", MICROS))
        return arrived_messages(users, [F.col("id"), told.alias("timestamp")])

    root = _run(spark, sf_dir, _one("user_inflow", "append"), rows, number % 17 == 0)
    return _windows(tables.table(spark, root, "user_inflow"))


def stream_age_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per bracket and micro-batch, added up to one bar per bracket."""
    root = _run(spark, sf_dir, _one("age_distribution", per_batch=True))
    return views.bracket_bars(tables.table(spark, root, "age_distribution"))


def stream_age_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but past batches are appended and leave the state."""
    start = _one("age_distribution", "append", per_batch=True, watermark="0 seconds")
    root = _run(spark, sf_dir, start)
    return views.bracket_bars(tables.table(spark, root, "age_distribution"))


def _long(spark: SparkSession, root: str, read=None) -> DataFrame:
    """The five result tables as one long frame; ``read`` gives a table by name, with its
    batch."""
    lineage = ["batch_id"] if read else []
    read = read or (lambda name: tables.table(spark, root, name))
    keys = {
        "gender_distribution": F.col("gender"),
        "age_distribution": F.col("age_group"),
        "country_distribution": F.col("country"),
        "user_inflow": F.col("window_start").cast(NTZ).cast("string"),
        "avg_age_by_country": F.col("country"),
    }
    parts = [
        read(name).select(
            F.lit(name).alias("result"),
            key.alias("series"),
            "count",
            (F.col("avg_age") if name == "avg_age_by_country" else F.lit(None))
            .cast("double")
            .alias("avg_age"),
            *lineage,
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _all(**how):
    """Start the whole pipeline."""

    def start(messages: DataFrame, root: str, checkpoint: str):
        return pipeline.run_pipeline(
            messages, root, checkpoint, every=None, inflow_by="record", **how
        )

    return start


def stream_all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five queries side by side."""
    return _long(spark, _run(spark, sf_dir, _all()))


def stream_shared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query that scans the topic once for all five results."""
    return _long(spark, _run(spark, sf_dir, _all(shared_scan=True)))


def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a shared scan, all read through the newest snapshot; whether each row is
    of the snapshot's batch."""
    root = _run(spark, sf_dir, _all(shared_scan=True))
    newest = snapshots.latest(spark, root)
    rows = _long(spark, root, lambda name: newest.table(spark, name))
    return rows.select("result", "series", "count", "avg_age", (F.col("batch_id") == newest.batch_id).alias("of_batch"))


def stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences of a stream's snapshots, one applied after the other: the last rows."""
    root = _run(spark, sf_dir, _all(shared_scan=True))
    keys, columns = ["country"], ["country", "avg_age", "count"]
    rows, since = None, None
    for number in snapshots.numbers(spark, root):
        feed = snapshots.changes_between(spark, root, "avg_age_by_country", keys, since, number)
        if rows is None:
            rows = snapshots.at(spark, root, number).table(spark, "avg_age_by_country").where("false")
        rows, since = snapshots.apply_changes(rows, feed, keys), number
    return rows.select(*columns)


def stream_count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the later half of the messages changed in the countries' counts."""
    root = _run(spark, sf_dir, _all(shared_scan=True))
    first, *_, last = snapshots.numbers(spark, root)
    feed = snapshots.changes_between(spark, root, "country_distribution", ["country"], first, last)
    more = F.col("new_count") - F.coalesce("old_count", F.lit(0))
    return feed.where(more != 0).select("country", more.alias("more"))


def stream_shared_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query for the four small results, and closed windows of inflow."""
    return _long(spark, _run(spark, sf_dir, _all(shared_scan=True, mode="bounded")))


def backfill_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five tables by one batch job over all messages."""
    root = scratch(spark, "backfill")
    pipeline.backfill(user_messages(spark, sf_dir), root, inflow_by="record")
    return _long(spark, root)


def backfill_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of records in the published shape, which tell no time of their own:
    inflow is by the topic's."""
    root = scratch(spark, "backfill")
    pipeline.backfill(arrived_messages(user_records(spark, sf_dir), raw_columns()), root)
    return _long(spark, root)


def stream_parsed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse once into a columnar table, then aggregate a stream of that table."""

    def start(messages: DataFrame, root: str, checkpoint: str):
        parsed = f"{root}/parsed"
        pipeline.wait_for(
            [pipeline.land_users(messages, parsed, f"{checkpoint}/parsed", every=None)]
        )
        users = pipeline.stream_users(spark, parsed)
        return [
            pipeline.start_result(
                analytics.gender_distribution(users), root, "gender_distribution",
                checkpoint, every=None,
            )
        ]

    root = _run(spark, sf_dir, start)
    return tables.find(spark, root, "gender_distribution", columns=["gender", "count"])


def ingest_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed record files to topic rows by a stream, then parsed as a batch."""
    base = scratch(spark, "ingest")
    records = raw_records(user_records(spark, sf_dir))
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    records.select(whole.alias("value")).write.text(f"{base}/records")

    lines = topic.stream_record_files(spark, f"{base}/records")
    messages = topic.encode_records(lines)
    pipeline.wait_for([topic.land_stream(messages, f"{base}/topic", f"{base}/checkpoint")])

    landed = topic.read_topic_files(spark, f"{base}/topic")
    return parse_users(landed, fields=("id", "gender", "age", "country", "nationality"))


def ingest_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, while all records land a second time, some of them before and some after the
    stream is started anew."""
    base = scratch(spark, "ingest")
    records = raw_records(user_records(spark, sf_dir))
    whole = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    some = F.crc32("value") % 2 == 0
    for landing in (whole.unionByName(whole.where(some)), whole.where(~some)):
        landing.write.mode("append").text(f"{base}/records")
        messages = topic.encode_records(topic.stream_record_files(spark, f"{base}/records"))
        query = topic.land_stream(messages, f"{base}/topic", f"{base}/checkpoint", repeats=topic.REPEATS)
        pipeline.wait_for([query])
    landed = topic.read_topic_files(spark, f"{base}/topic")
    return parse_users(landed, fields=("id", "gender", "age", "country", "nationality"))


def _late_inflow(spark: SparkSession, sf_dir: str) -> str:
    """Inflow that keeps late rows: every 17th user of the earlier half lands with the later."""
    number = F.substring("id", 3, 20).cast("bigint")

    def start(messages: DataFrame, root: str, checkpoint: str):
        users = with_event_time(parse_users(messages, fields=("id", "timestamp")))
        return [late.start_inflow(users, root, checkpoint, every=None)]

    return _run(spark, sf_dir, start, late=number % 17 == 0)


def stream_inflow_late_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows, late rows counted in."""
    return _windows(late.closed(spark, _late_inflow(spark, sf_dir)))


def stream_inflow_late_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, open ones too: the batch answer."""
    return _windows(late.inflow(spark, _late_inflow(spark, sf_dir)))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refused rows, and the watermark that refused them."""
    rows = late.late_rows(spark, _late_inflow(spark, sf_dir))
    return rows.select("id", F.col("timestamp").cast(NTZ).alias("ts"), F.col("watermark").cast(NTZ).alias("watermark"))


def stream_latest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest record of each of 500 users, by keyed state and an upsert into buckets."""
    number = F.substring("id", 3, 20).cast("bigint")

    def rows(users: DataFrame) -> DataFrame:
        few = users.withColumn("id", F.concat(F.lit("c-"), (number % 500).cast("string")))
        return arrived_messages(few, flat_columns())

    def start(messages: DataFrame, root: str, checkpoint: str):
        users = with_event_time(parse_users(messages, fields=("id", "gender", "age", "country", "timestamp")))
        return [latest.start_latest(users, root, checkpoint, every=None, count=8, state_partitions=4)]

    root = _run(spark, sf_dir, start, rows)
    kept = buckets.read(spark, root, latest.NAME)
    return kept.select("id", "gender", "age", "country", F.col("timestamp").cast(NTZ).alias("ts"))


def stream_inflow_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows added to levels of time batch by batch; the hours of the closed windows."""

    def start(messages: DataFrame, root: str, checkpoint: str):
        inflow = pipeline.topic_results(messages, inflow_by="record")["user_inflow"]
        sink = levels.adding(root, "inflow")
        return [pipeline.start_result(inflow, root, "inflow", checkpoint, "append", every=None, sink=sink)]

    root = _run(spark, sf_dir, start)
    hours = levels.series(spark, root, "inflow", 60, datetime(1970, 1, 1), datetime(9999, 1, 1))
    return hours.select(wall_clock(F.col("window_start")).alias("window_start"), "count")


def stream_top_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch for each batch; the values that the merged one names, counted exactly."""
    feeds = []

    def start(messages: DataFrame, root: str, checkpoint: str):
        values = parse_users(messages, fields=("id",)).select(spread_series())
        feeds.append(f"{root}/sketches")
        sink = sketches.sketching(feeds[0], "series", 1000)
        return [pipeline.start_result(values, root, "sketches", checkpoint, "append", every=None, sink=sink)]

    _run(spark, sf_dir, start)
    users = parse_users(user_messages(spark, sf_dir), fields=("id",)).select(spread_series())
    return frequent.top_k(users, "series", tracked=1000, sketched=sketches.merged(spark, feeds[0], 1000))


QUERIES = {
    query.__name__: query
    for query in (
        stream_avg_age,
        stream_gender_every,
        stream_inflow_complete,
        stream_inflow_append,
        stream_inflow_update,
        stream_inflow_by_arrival,
        stream_inflow_untrusted,
        stream_age_per_batch,
        stream_age_bounded,
        stream_all_results,
        stream_shared_scan,
        stream_snapshot,
        stream_change_feed,
        stream_count_changes,
        stream_shared_bounded,
        stream_parsed_table,
        backfill_results,
        backfill_raw_records,
        ingest_raw_records,
        ingest_without_repeats,
        stream_inflow_late_merged,
        stream_inflow_late_now,
        stream_late_rows,
        stream_latest_users,
        stream_inflow_levels,
        stream_top_frequent,
    )
}
