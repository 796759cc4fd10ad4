from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_streaming import Feed

from userflow.operators import analytics
from userflow.operators.parse import parse_users, with_event_time
from userflow.sources import snapshots, tables, topic
from userflow.streaming import late, pipeline

NOON = datetime(2024, 1, 1, 12)


def record(i, seconds):
    at = None if seconds is None else (NOON + timedelta(seconds=seconds)).isoformat()
    return {"id": f"u{i}", "timestamp": at}


BATCHES = [
    [record(1, 10), record(2, 20), record(3, None)],
    [record(4, 600)],
    [record(5, 30), record(6, 590), record(7, 605)],  # the first window was closed by 600
    [record(8, 1200)],
    [record(9, 15), record(10, 3000), record(11, 700)],
    [record(12, 86_400 * 2)],
    [record(13, 20), record(14, 86_400)],
]


def users_of(rows):
    return with_event_time(parse_users(rows, fields=("id", "timestamp")))


def counts(rows):
    return {r.window_start: r["count"] for r in rows.collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def run(feed, root, checkpoint):
    pipeline.wait_for([late.start_inflow(users_of(feed.stream()), root, checkpoint, every=None)])


def test_closed_and_late_are_the_batch_answer_after_each_resume(spark, feed, tmp_path):
    root, checkpoint = f"{tmp_path}/tables", f"{tmp_path}/checkpoints"
    for batch in BATCHES:
        feed.land(batch)
        run(feed, root, checkpoint)
        want = counts(analytics.user_inflow(users_of(feed.batch()), "timestamp"))
        assert counts(late.inflow(spark, root)) == want
    refused = {r.id: (r.watermark, r.batch_id) for r in late.late_rows(spark, root).collect()}
    marks = {i: r[0] - NOON for i, r in refused.items()}
    assert marks == {"u5": timedelta(seconds=540), "u9": timedelta(seconds=1140), "u11": timedelta(seconds=1140), "u13": timedelta(days=2, seconds=-60), "u14": timedelta(days=2, seconds=-60)}
    shut = {r.window_start - NOON: (r["count"], r.late) for r in late.closed(spark, root).collect()}
    assert shut[timedelta(0)] == (5, 3) and shut[timedelta(minutes=11)] == (1, 1) and shut[timedelta(minutes=50)] == (1, 0)
    # The state holds what is open, not what was ever seen.
    assert late.open_windows(spark, root).count() == 1


@pytest.mark.parametrize("cut", ["late", "closed", "publish", "none"])
def test_a_batch_run_again_counts_once(spark, feed, tmp_path, monkeypatch, cut):
    root = f"{tmp_path}/tables"
    write = late.keeping_late(spark, root)
    for n, batch in enumerate(BATCHES[:5]):
        feed.land(batch)
        rows = users_of(spark.read.parquet(f"{feed.path}/{n:04d}.parquet"))
        if n == 4 and cut != "none":
            target = {"late": (late, "_written"), "closed": (tables, "upsert_dated"), "publish": (snapshots, "publish")}[cut]
            with monkeypatch.context() as patch:
                own = getattr(*target)

                def killed(*args, own=own, **how):
                    if cut == "closed":
                        own(*args, **how)
                    raise RuntimeError("killed")

                patch.setattr(*target, killed)
                with pytest.raises(RuntimeError, match="killed"):
                    write(rows, n)
        write(rows, n)
    write(rows, 4)
    assert counts(late.inflow(spark, root)) == counts(analytics.user_inflow(users_of(feed.batch()), "timestamp"))
    assert late.late_rows(spark, root).count() == 3
    assert snapshots.latest(spark, f"{root}/user_inflow_state").batch_id == 4


def messages(spark, rows):
    return spark.createDataFrame([(k and k.encode(), v and v.encode(), t) for k, v, t in rows], "key binary, value binary, timestamp timestamp")


def test_repeats_go_and_their_state_is_freed(spark, feed, tmp_path):
    def land(n, seconds, ids):
        rows = [(f'{{"uuid": "{i}"}}' if i else None, f'{{"gender": "g{i}"}}', NOON + timedelta(seconds=seconds)) for i in ids]
        topic.as_topic_rows(messages(spark, rows), arrived=F.col("timestamp")).coalesce(1).write.parquet(f"{feed.path}/{n}")

    def run(n):
        stream = topic.without_repeats(topic.stream_topic_files(spark, f"{feed.path}/*"), "10 minutes")
        result = pipeline.topic_results(stream)["gender_distribution"]
        query = pipeline.start_result(result, f"{tmp_path}/tables", "gender_distribution", f"{tmp_path}/checkpoints", every=None)
        pipeline.wait_for([query])
        held = [op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"] if op["operatorName"].startswith("dedupe")]
        return {r.gender: r["count"] for r in tables.table(spark, f"{tmp_path}/tables", "gender_distribution").collect()}, held[0]

    land(0, 0, [1, 2, 2, None, None])
    assert run(0) == ({"g1": 1, "g2": 1, "gNone": 1}, 3)
    land(1, 60, [1, 2, 3, None])  # a landing again, and one that is new
    assert run(1) == ({"g1": 1, "g2": 1, "gNone": 1, "g3": 1}, 4)
    land(2, 3600, [4])
    run(2)
    land(3, 3700, [4, 5])
    got, held = run(3)
    assert got == {"g1": 1, "g2": 1, "gNone": 1, "g3": 1, "g4": 1, "g5": 1} and held <= 2


def test_repeats_of_a_batch(spark):
    rows = [("a", "1", NOON), ("a", "2", NOON), (None, "1", NOON), (None, "1", NOON), (None, "2", None), (None, None, NOON)]
    assert topic.without_repeats(messages(spark, rows)).count() == 4
    placed = topic.as_topic_rows(messages(spark, [(None, None, NOON)] * 3)).withColumn("offset", F.monotonically_increasing_id())
    assert topic.without_repeats(placed).count() == 3
    assert topic.without_repeats(messages(spark, [])).count() == 0
