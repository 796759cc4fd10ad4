import json
import os
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from userflow.operators import analytics, views
from userflow.operators.parse import parse_users, with_event_time
from userflow.sources import tables, topic
from userflow.streaming import pipeline

MIDNIGHT = datetime(2024, 1, 1)
ARRIVAL = datetime(2024, 1, 2)


class Feed:
    """A folder of topic files whose order of arrival is fixed."""

    def __init__(self, spark, base):
        self.spark, self.path, self.files = spark, f"{base}/topic", 0
        os.makedirs(self.path)

    def land(self, records, arrived=ARRIVAL):
        """Add one file of JSON records that the topic got at one time."""
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        count = len(lines)
        rows = pa.table(
            {
                "key": pa.nulls(count, pa.binary()),
                "value": pa.array([line.encode() for line in lines], pa.binary()),
                "topic": pa.array(["user_data"] * count),
                "partition": pa.nulls(count, pa.int32()),
                "offset": pa.nulls(count, pa.int64()),
                "timestamp": pa.array([arrived] * count, pa.timestamp("us", "UTC")),
                "timestampType": pa.array([0] * count, pa.int32()),
            }
        )
        target = f"{self.path}/{self.files:04d}.parquet"
        pq.write_table(rows, target)
        written = time.time() - 10_000 + 10 * self.files
        os.utime(target, (written, written))
        self.files += 1

    def stream(self, max_files=1):
        return topic.stream_topic_files(self.spark, self.path, max_files)

    def batch(self):
        return topic.read_topic_files(self.spark, self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


@pytest.fixture
def places(tmp_path):
    return f"{tmp_path}/tables", f"{tmp_path}/checkpoints"


def at(text):
    hours, minutes, seconds = map(int, text.split(":"))
    moment = MIDNIGHT + timedelta(hours=hours, minutes=minutes, seconds=seconds)
    return moment.isoformat()


def people(n, start=0):
    return [
        {
            "gender": ("m", "f", None)[i % 3],
            "age": None if i % 5 == 0 else i % 90,
            "location": {"country": f"C{i % 4}"},
            "timestamp": at(f"0:{i % 60}:{i % 7}"),
        }
        for i in range(start, start + n)
    ]


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


# State of few keys: fewer files to commit per batch.
SMALL = {"every": None, "state_partitions": 2}


def run(queries):
    pipeline.wait_for(queries)
    return queries


COLUMNS = {
    "gender_distribution": ["gender", "count"],
    "age_distribution": ["age_group", "count"],
    "country_distribution": ["country", "count"],
    "user_inflow": ["window_start", "window_end", "count"],
    "avg_age_by_country": ["country", "avg_age", "count"],
}


def batch_answers(feed):
    users = parse_users(feed.batch(), fields=("gender", "age", "country", "timestamp"))
    users = with_event_time(users).withColumn("processed_timestamp", F.current_timestamp())
    results = analytics.all_analytics(users, time_col="timestamp")
    return {name: as_set(df, *COLUMNS[name]) for name, df in results.items()}


@pytest.mark.parametrize("per_batch", [False, True])
def test_update_mode_reaches_the_same_tables(spark, feed, places, per_batch):
    root, checkpoint = places
    for step in range(2):
        feed.land(people(40, start=40 * step) + ["not json"])
        run(pipeline.run_pipeline(
            feed.stream(), root, checkpoint, "update", per_batch=per_batch, **SMALL
        ))
    answers = batch_answers(feed)
    for name in ("gender_distribution", "country_distribution", "avg_age_by_country"):
        assert as_set(tables.table(spark, root, name), *COLUMNS[name]) == answers[name], name
    ages = tables.table(spark, root, "age_distribution")
    assert ages.select("timestamp").distinct().count() == 2
    bars = views.bracket_bars(ages)
    assert as_set(bars, *COLUMNS["age_distribution"]) == answers["age_distribution"]
    inflow = tables.table(spark, root, "user_inflow")
    assert views.total(inflow).first().total == 82


def test_queries_that_cannot_all_start_leave_none_running(spark, feed, places):
    feed.land(people(3))
    results = pipeline.topic_results(feed.stream())
    broken = {**results, "gender_distribution": feed.batch()}
    order = ["country_distribution", "gender_distribution"]
    before = set(q.id for q in spark.streams.active)
    with pytest.raises(Exception):
        pipeline.start_all({n: broken[n] for n in order}, *places, every="1 second")
    assert set(q.id for q in spark.streams.active) == before
    with pytest.raises(ValueError, match="bounded"):
        pipeline.run_pipeline(feed.stream(), *places, mode="append")


@pytest.mark.parametrize("shared", [False, True])
def test_streams_equal_the_batch_and_resume(spark, feed, places, shared):
    root, checkpoint = places
    for step in range(2):
        for part in range(2):
            feed.land(people(40, start=100 * step + 40 * part) + ["not json"])
        run(pipeline.run_pipeline(
            feed.stream(), root, checkpoint, shared_scan=shared, inflow_by="record", **SMALL
        ))
        for name, answer in batch_answers(feed).items():
            table = tables.table(spark, root, name)
            assert as_set(table, *COLUMNS[name]) == answer, (step, name)
            assert {"timestamp", "batch_id", "updated_at"} <= set(table.columns)
            assert len(as_set(table, "batch_id")) == 1


def test_dashboard_reads_the_result_tables(spark, feed, places):
    feed.land(people(60))
    run(pipeline.run_pipeline(feed.stream(), *places, inflow_by="record", **SMALL))
    results = {name: tables.table(spark, places[0], name) for name in COLUMNS}
    as_of = F.lit(MIDNIGHT + timedelta(hours=1))
    panels = {t: df.collect() for t, df in views.panels(results, as_of).items()}
    assert [len(rows) for rows in panels.values()] == [5, 3, 7, 4, 4]
    assert sum(r.percent for r in panels["Gender Distribution"]) == pytest.approx(100)
    starts = [r.window_start.minute for r in panels["User Inflow Over Time"]]
    assert starts == [55, 56, 57, 58, 59]


def test_shared_scan_with_bounded_state(spark, feed, places):
    root, checkpoint = places
    for step in range(2):
        feed.land(people(60, start=60 * step) + ["not json"])
        queries = run(pipeline.run_pipeline(
            feed.stream(), root, checkpoint, "bounded", shared_scan=True, inflow_by="record",
            watermark="0 seconds", **SMALL,
        ))
        assert [q.name for q in queries] == ["combined", "user_inflow"]
        answers = batch_answers(feed)
        inflow = answers.pop("user_inflow")
        for name, answer in answers.items():
            assert as_set(tables.table(spark, root, name), *COLUMNS[name]) == answer, name
        if step == 0:
            last = max(inflow)
            closed = as_set(tables.table(spark, root, "user_inflow"), *COLUMNS["user_inflow"])
            assert closed == inflow - {last}
    # The second feed repeats the minutes of the first: all but the last are over.
    rows = tables.table(spark, root, "user_inflow").collect()
    assert len(rows) == 59


def test_processing_time_is_one_window_per_batch(spark, feed, places):
    feed.land(people(30))
    run(pipeline.run_pipeline(feed.stream(), *places, **SMALL))
    rows = tables.table(spark, places[0], "user_inflow").collect()
    assert [r["count"] for r in rows] == [30]


def test_age_counts_per_batch_never_merge(spark, feed, places):
    root, checkpoint = places
    for _ in range(4):
        feed.land([{"age": 20}, {"age": 20}, {"age": 70}])
    results = pipeline.topic_results(feed.stream(), per_batch=True)
    run(
        [
            pipeline.start_result(
                results["age_distribution"], root, "age_distribution", checkpoint, **SMALL
            )
        ]
    )
    rows = tables.table(spark, root, "age_distribution").collect()
    assert len(rows) == 8
    assert sum(r["count"] for r in rows) == 12


def test_bounded_modes_free_the_state_of_past_batches(spark, feed, places):
    root, checkpoint = places
    for _ in range(5):
        feed.land([{"age": 20}, {"age": 20}, {"age": 70}])
    queries = run(pipeline.run_pipeline(
        feed.stream(), root, checkpoint, "bounded", per_batch=True,
        watermark="0 seconds", window="1 second", **SMALL,
    ))
    by_name = {q.name: q for q in queries}
    for name in ("user_inflow", "age_distribution"):
        states = [p["stateOperators"][0] for p in by_name[name].recentProgress]
        assert max(s["numRowsTotal"] for s in states) <= 4, name
        assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    ages = tables.table(spark, root, "age_distribution").collect()
    assert sorted((r.age_group, r["count"]) for r in ages) == [("18-24", 2)] * 5 + [("65+", 1)] * 5
    assert len({r.timestamp for r in ages}) == 5
    genders = tables.table(spark, root, "gender_distribution").collect()
    assert [r["count"] for r in genders] == [15]


def test_a_replayed_batch_leaves_one_copy(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame([("m", 1), ("f", 2)], "gender string, count long")
    write = pipeline.replacing(root, "g")
    write(batch, 5)
    write(batch, 5)
    write(batch.where("false"), 6)
    rows = tables.table(spark, root, "g").collect()
    assert sorted((r.gender, r["count"], r.batch_id) for r in rows) == [("f", 2, 5), ("m", 1, 5)]

    merge = pipeline.upserting(spark, root, "u", ["gender"])
    merge(batch, 0)
    merge(batch, 0)
    merge(batch.where("gender = 'm'").withColumn("count", F.lit(9).cast("long")), 1)
    assert as_set(tables.table(spark, root, "u"), "gender", "count") == {("m", 9), ("f", 2)}


# One file per batch. The late row comes right after the batch that moves the time on.
LATE_NEXT = [["0:0:10", "0:0:20"], ["0:10:0"], ["0:0:30"], ["0:20:0"]]
# The late row comes one batch later still.
LATE_AFTER = [["0:0:20"], ["0:10:0"], ["0:10:5"], ["0:0:30"], ["0:20:0"]]


def inflow(spark, feed, places, mode, sequence):
    root, checkpoint = places
    for times in sequence:
        feed.land([{"timestamp": at(t)} for t in times])
    results = pipeline.topic_results(feed.stream(), inflow_by="record")
    (query,) = run(
        [
            pipeline.start_result(
                results["user_inflow"], root, "user_inflow", checkpoint, mode, **SMALL
            )
        ]
    )
    dropped = sum(
        op["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )
    rows = tables.table(spark, root, "user_inflow").collect()
    return {(r.window_start - MIDNIGHT).seconds // 60: r["count"] for r in rows}, dropped


@pytest.mark.parametrize(
    "mode,sequence,counts,dropped",
    [
        ("complete", LATE_NEXT, {0: 3, 10: 1, 20: 1}, 0),
        ("update", LATE_NEXT, {0: 3, 10: 1, 20: 1}, 0),
        ("append", LATE_NEXT, {0: 3, 10: 1}, 0),
        ("complete", LATE_AFTER, {0: 2, 10: 2, 20: 1}, 0),
        ("update", LATE_AFTER, {0: 1, 10: 2, 20: 1}, 1),
        ("append", LATE_AFTER, {0: 1, 10: 2}, 1),
    ],
)
def test_watermark_acts_outside_complete_mode(
    spark, feed, places, mode, sequence, counts, dropped
):
    assert inflow(spark, feed, places, mode, sequence) == (counts, dropped)


def test_parsed_table_in_between(spark, feed, places, tmp_path):
    root, checkpoint = places
    feed.land(people(20))
    feed.land(people(20, start=50))
    parsed = f"{tmp_path}/parsed"
    run([pipeline.land_users(feed.stream(), parsed, f"{checkpoint}/land", every=None)])
    users = pipeline.stream_users(spark, parsed, max_files=1)
    assert users.dtypes == spark.read.parquet(parsed).dtypes
    results = analytics.all_analytics(users, as_of=F.current_timestamp())
    run(pipeline.start_all(results, root, checkpoint, **SMALL))
    for name in ("gender_distribution", "country_distribution", "avg_age_by_country"):
        got = as_set(tables.table(spark, root, name), *COLUMNS[name])
        assert got == batch_answers(feed)[name], name


def test_a_failing_query_stops_the_others(spark, feed, places):
    feed.land(people(3))
    results = pipeline.topic_results(feed.stream())

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    root, checkpoint = places
    steady = pipeline.start_result(
        results["gender_distribution"], root, "gender_distribution", checkpoint, every="1 second"
    )
    broken = pipeline.start_result(
        results["country_distribution"], root, "country_distribution", checkpoint,
        every="1 second", sink=fail,
    )
    with pytest.raises(Exception, match="sink is down"):
        pipeline.wait_for([steady, broken])
    assert not steady.isActive and not broken.isActive


def test_state_partitions_do_not_change_the_session(spark, feed, places):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    feed.land(people(3))
    results = {"gender_distribution": pipeline.topic_results(feed.stream())["gender_distribution"]}
    queries = run(pipeline.start_all(results, *places, every=None, state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    states = [p["stateOperators"][0]["numShufflePartitions"] for p in queries[0].recentProgress]
    assert set(states) == {3}


def test_shared_scan_needs_complete_mode(spark, feed, places):
    feed.land(people(1))
    with pytest.raises(ValueError):
        pipeline.run_pipeline(feed.stream(), *places, mode="update", shared_scan=True)
    with pytest.raises(ValueError):
        pipeline.run_pipeline(feed.stream(), *places, shared_scan=True, per_batch=True)
    with pytest.raises(ValueError, match="per minute"):
        pipeline.run_pipeline(feed.stream(), *places, shared_scan=True, window="1 hour")


def arrivals(spark, root):
    return as_set(tables.table(spark, root, "user_inflow"), "window_start", "count")


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_a_wrong_clock_loses_no_row(spark, feed, places, mode):
    root, checkpoint = places
    results = pipeline.topic_results(feed.stream(), inflow_by="record")
    corrected = dropped = 0
    for minute in range(6):
        told = at(f"1:{minute}:30") if minute != 1 else "2999-01-01T00:00:00"
        feed.land([{"timestamp": told}], MIDNIGHT + timedelta(hours=1, minutes=minute, seconds=31))
        query = pipeline.start_result(results["user_inflow"], root, "user_inflow", checkpoint, mode, **SMALL)
        run([query])
        corrected += sum(p.observedMetrics["event_times"].corrected for p in query.recentProgress if p.numInputRows)
        dropped += sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert (corrected, dropped) == (1, 0)
    final = 4 if mode == "append" else 6
    assert arrivals(spark, root) == {(MIDNIGHT + timedelta(hours=1, minutes=i), 1) for i in range(final)}


def test_inflow_by_arrival_decodes_nothing(spark, feed, places):
    root, checkpoint = places
    feed.land(people(7) + ["not json"])
    results = pipeline.topic_results(feed.stream(), inflow_by="arrival")
    plan = pipeline.topic_results(feed.batch(), inflow_by="arrival")["user_inflow"]
    assert "from_json" not in plan._jdf.queryExecution().optimizedPlan().toString()
    run([pipeline.start_result(results["user_inflow"], root, "user_inflow", checkpoint, **SMALL)])
    assert arrivals(spark, root) == {(ARRIVAL, 8)}
    with pytest.raises(ValueError, match="inflow is by"):
        pipeline.topic_results(feed.batch(), inflow_by="event")


def test_backfill_counts_by_arrival_and_makes_every_table(spark, feed, places):
    root, _ = places
    feed.land(people(5))
    pipeline.backfill(feed.batch(), root, unknown_label="unknown")
    assert arrivals(spark, root) == {(ARRIVAL, 5)}
    assert tables.table(spark, root, "age_distribution").where("age_group = 'unknown'").first()["count"] == 1
    timeless = feed.batch().withColumn("timestamp", F.lit(None).cast("timestamp"))
    pipeline.backfill(timeless, f"{root}/other")
    assert arrivals(spark, f"{root}/other") == set()
    assert tables.table(spark, f"{root}/other", "gender_distribution").count() == 3


def test_append_streams_and_versions_do_not_mix(spark, feed, places):
    root, checkpoint = places
    feed.land(people(5))
    run(pipeline.run_pipeline(feed.stream(), root, checkpoint, **SMALL))
    with pytest.raises(ValueError, match="no append stream"):
        pipeline.run_pipeline(feed.stream(), root, f"{checkpoint}/new", "bounded", **SMALL)
    other = f"{root}/other"
    run(pipeline.run_pipeline(feed.stream(), other, f"{checkpoint}/other", "bounded", inflow_by="record", **SMALL))
    rows = tables.table(spark, other, "user_inflow")
    for write in (tables.replace, tables.append):
        with pytest.raises(ValueError, match="append stream"):
            write(rows, other, "user_inflow")


def test_closed_dates_are_archived_in_few_files(spark, feed, places, tmp_path):
    root, checkpoint = places
    for step in range(4):
        feed.land(people(6, 6 * step))
        run([pipeline.land_users(feed.stream(), f"{root}/users", f"{checkpoint}/users", every=None, files=2)])
    landed, archive = f"{root}/users", f"{root}/archive"

    def files(path):
        return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)

    pipeline.archive_dates(spark, landed, archive, "2024-01-01")
    assert files(archive) == 0
    for _ in range(2):
        pipeline.archive_dates(spark, landed, archive, "2999-01-01")
        assert files(archive) < files(landed)
        columns = ["gender", "age", "country", "arrival_date"]
        got, want = (sorted(map(str, spark.read.parquet(p).select(*columns).collect())) for p in (archive, landed))
        assert got == want and len(got) == 24
