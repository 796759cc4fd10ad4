import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_streaming import Feed

from userflow.operators.parse import parse_users, with_event_time
from userflow.sources import buckets
from userflow.streaming import latest, pipeline

START = datetime(2024, 1, 1)


def record(user, minutes, age):
    return {"id": user, "age": age, "gender": "x" if age and age % 2 else None, "timestamp": None if minutes is None else (START + timedelta(minutes=minutes)).isoformat()}


def users_of(rows):
    return with_event_time(parse_users(rows, fields=("id", "age", "gender", "timestamp")))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def run(feed, tmp_path, **how):
    query = latest.start_latest(users_of(feed.stream()), f"{tmp_path}/tables", f"{tmp_path}/checkpoints", every=None, count=8, state_partitions=2, **how)
    pipeline.wait_for([query])
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def as_set(rows):
    return {tuple(r) for r in rows.select("id", "age", "gender", "timestamp").collect()}


def test_equals_the_batch_answer_after_each_resume(spark, feed, tmp_path):
    draw = random.Random(4)
    for step in range(3):
        # Out of order within an hour, with equal times, nulls, and repeated records.
        rows = [record(f"u{draw.randrange(40)}", 50 * step + draw.randrange(55), draw.choice([None, 3, 30, 50])) for _ in range(200)]
        feed.land([*rows, rows[0], record(None, 500, 1), record("timeless", None, 1), "no json"])
        run(feed, tmp_path, watermark="2 hours")
        got = buckets.read(spark, f"{tmp_path}/tables", "latest_users")
        assert as_set(got) == as_set(latest.latest_users(users_of(feed.batch()))) and got.count() == got.select("id").distinct().count()


def test_state_of_idle_users_is_cleared(spark, feed, tmp_path):
    held = []
    for step in range(5):
        feed.land([record(f"u{step}-{i}", step * 24 * 60, 1) for i in range(30)] + [record("always", step * 24 * 60, step)])
        held.append(run(feed, tmp_path, idle="36 hours", watermark="1 hour")[-1])
    # 31 at first; later two days' users, and never all 151. Each has a value and a timer.
    per_user = held[0] / 31
    assert held[-1] <= 2 * 31 * per_user
    rows = buckets.read(spark, f"{tmp_path}/tables", "latest_users")
    assert rows.count() == 151 and rows.where("id = 'always'").first().age == 4


def test_batch_takes_the_newest(spark):
    rows = spark.createDataFrame([("a", 1, START), ("a", 2, START + timedelta(1)), ("b", None, START), (None, 4, START), ("c", 5, None), ("a", 2, START + timedelta(1))], "id string, age int, timestamp timestamp")
    assert {tuple(r)[:2] for r in latest.latest_users(rows).collect()} == {("a", 2), ("b", None)}
    ties = spark.createDataFrame([("a", i, START) for i in range(9)], "id string, age int, timestamp timestamp")
    assert latest.latest_users(ties).collect() == latest.latest_users(ties.repartition(5).orderBy(F.desc("age"))).collect()
    assert latest.latest_users(rows.where("false")).collect() == []


def test_tasks_give_the_state_few_records_of_a_user(spark, feed, tmp_path):
    draw = random.Random(7)
    feed.land([record(f"u{draw.randrange(3)}", draw.randrange(600), i) for i in range(3000)])
    query = latest.start_latest(users_of(feed.stream()), f"{tmp_path}/tables", f"{tmp_path}/checkpoints", every=None, count=8, state_partitions=2)
    pipeline.wait_for([query])
    assert as_set(buckets.read(spark, f"{tmp_path}/tables", "latest_users")) == as_set(latest.latest_users(users_of(feed.batch())))
    beaten = latest._without_beaten(latest._ordered(users_of(feed.batch()), "id", "timestamp"), "id")
    assert beaten.count() <= 3 * beaten.rdd.getNumPartitions()


def test_the_newest_stays_whatever_is_held(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, 3, 4, None]), i % 5, None if i % 9 == 0 else START + timedelta(minutes=draw.randrange(20))) for i in range(400)]
    users = spark.createDataFrame(rows, "id int, age int, timestamp timestamp").repartition(3)
    want = {tuple(r) for r in latest.latest_users(users).collect()}
    monkeypatch.setattr(latest, "COMBINED", 1)
    some = latest._without_beaten(latest._ordered(users, "id", "timestamp"), "id").drop(latest.MICROS, latest.TIE)
    assert {tuple(r) for r in latest.latest_users(some).collect()} == want
    pairs = users.withColumn("id", F.struct("id", "age"))
    assert latest._without_beaten(latest._ordered(pairs, "id", "timestamp"), "id").count() == pairs.where("id is not null and timestamp is not null").count()
