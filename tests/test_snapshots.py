from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from userflow.operators import analytics
from userflow.sources import files, snapshots, tables
from userflow.streaming import pipeline


def combined(spark, n):
    users = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("gender"),
        (F.col("id") % 70).cast("int").alias("age"), F.lit("c").alias("country"), F.lit("2024-01-01").cast("timestamp").alias("processed_timestamp"),
    )
    return analytics.analytics_in_one_pass(users).withColumn("timestamp", F.current_timestamp())


def totals(spark, root, snapshot=None):
    read = (lambda n: snapshot.table(spark, n)) if snapshot else (lambda n: tables.table(spark, root, n))
    return {name: read(name).agg(F.sum("count"), F.max("batch_id")).first()[:] for name in pipeline.RESULTS}


def test_all_tables_move_at_once(spark, tmp_path, monkeypatch):
    root, seen, move = str(tmp_path), [], files.move
    write = pipeline.splitting(spark, root)
    write(combined(spark, 10), 0)

    def watched(*args, **how):
        seen.append(set(totals(spark, root).values()))
        moved = move(*args, **how)
        seen.append(set(totals(spark, root).values()))
        return moved

    monkeypatch.setattr(files, "move", watched)
    write(combined(spark, 25), 1)
    assert seen == [{(10, 0)}, {(25, 1)}]


def test_a_killed_publish_leaves_the_snapshot_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write = pipeline.splitting(spark, root)
    write(combined(spark, 10), 0)

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(files, "move", killed)
        with pytest.raises(RuntimeError, match="killed"):
            write(combined(spark, 25), 1)
    assert set(totals(spark, root).values()) == {(10, 0)} and snapshots.numbers(spark, root) == [1]
    write(combined(spark, 25), 1)  # the batch again
    assert set(totals(spark, root).values()) == {(25, 1)} and snapshots.numbers(spark, root) == [1, 2]


def test_a_reader_stays_on_its_snapshot(spark, tmp_path):
    root = str(tmp_path)
    write = pipeline.splitting(spark, root)
    write(combined(spark, 10), 0)
    held = snapshots.latest(spark, root)
    write(combined(spark, 25), 1)
    assert set(totals(spark, root, held).values()) == {(10, 0)}
    assert set(totals(spark, root, snapshots.at(spark, root, 2)).values()) == {(25, 1)}
    assert snapshots.expire(spark, root, timedelta(hours=1)) == 0
    assert snapshots.expire(spark, root, timedelta(0)) == 1
    assert snapshots.numbers(spark, root) == [2] and set(totals(spark, root).values()) == {(25, 1)}
    assert len(list(files.entries(spark, f"{root}/gender_distribution/{tables.VERSIONS}"))) == 1
    with pytest.raises(ValueError, match="no snapshot 1"):
        snapshots.at(spark, root, 1)


def test_writers_of_other_tables_lose_nothing(spark, tmp_path):
    root = str(tmp_path)
    staged = {f"t{i}": tables.stage(spark.range(i + 1), root, f"t{i}") for i in range(6)}
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda t: snapshots.publish(spark, root, {t: staged[t]}), staged))
    newest = snapshots.latest(spark, root)
    assert newest.versions == staged and newest.number == 6
    assert [tables.table(spark, root, f"t{i}").count() for i in range(6)] == [1, 2, 3, 4, 5, 6]


def test_single_writers_publish_by_the_next_snapshot(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert snapshots.latest(spark, root) is None
    tables.replace(rows, root, "own")
    snapshots.publish(spark, root, {"shared": tables.stage(rows, root, "shared")}, batch_id=3, info={"note": 1})
    assert snapshots.latest(spark, root).info == {"note": 1}
    tables.upsert(spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string"), root, "shared", ["id"], insert=True)
    tables.append(spark.createDataFrame([(4, "d")], "id int, v string"), root, "shared")
    assert {tuple(r) for r in tables.table(spark, root, "shared").collect()} == {(1, "a"), (2, "b"), (3, "c"), (4, "d")}
    assert {tuple(r) for r in tables.table(spark, root, "own").collect()} == {(1, "a"), (2, None)}
    assert snapshots.numbers(spark, root) == [1, 2] and tables.exists(spark, root, "shared")
    assert snapshots.at(spark, root, 1).table(spark, "shared").count() == 2
    with pytest.raises(ValueError, match="snapshots"):
        tables.expire(spark, root, "shared", timedelta(0))
    with pytest.raises(ValueError, match="no table"):
        snapshots.latest(spark, root).path("own")


def test_changes_are_null_safe_and_add_up(spark):
    schema = "k int, g string, v double, w string"
    older = spark.createDataFrame([(1, "a", 1.0, None), (None, "a", 2.0, "x"), (2, None, None, "y"), (3, "b", 3.0, "z"), (5, "c", 0.0, "s")], schema)
    newer = spark.createDataFrame([(1, "a", 1.0, None), (None, "a", None, "x"), (2, None, 5.0, "y"), (4, "b", 3.0, "z"), (5, "c", 0.0, None)], schema)
    feed = snapshots.changes(older, newer, ["k", "g"])
    got = {(r.k, r.g): (r._change, r.old_v, r.new_v, r.old_w, r.new_w) for r in feed.collect()}
    assert got == {
        (None, "a"): ("changed", 2.0, None, "x", "x"), (2, None): ("changed", None, 5.0, "y", "y"), (5, "c"): ("changed", 0.0, 0.0, "s", None),
        (3, "b"): ("removed", 3.0, None, "z", None), (4, "b"): ("added", None, 3.0, None, "z"),
    }
    back = snapshots.apply_changes(older, feed, ["k", "g"])
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in newer.collect()}
    wider = newer.withColumn("extra", F.lit(1))
    assert snapshots.changes(newer, wider, ["k", "g"]).where("_change = 'changed' and new_extra = 1 and old_extra is null").count() == 5
    assert snapshots.changes(newer, newer, ["k", "g"]).isEmpty()
