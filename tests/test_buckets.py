import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from userflow.sources import buckets, files, snapshots


def rows(spark, n, factor=1):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") % 7 > 0, F.col("id") * factor).alias("v"), F.lit("x").alias("w"))


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.fixture
def root(spark, tmp_path):
    buckets.create(rows(spark, 20_000), str(tmp_path), "users", ["key"], 64)
    return str(tmp_path)


def test_a_small_update_touches_its_buckets_only(spark, root):
    before = buckets.current(spark, root, "users")
    assert len(before.held) == 64 and all(len(names) == 1 for names in before.held.values())
    changes = rows(spark, 20, factor=-1)  # 0.1 %
    counts = buckets.upsert(changes, root, "users")
    after = buckets.current(spark, root, "users")
    touched = {r[0] for r in changes.select(buckets.bucket_of(["key"], 64)).distinct().collect()}
    assert counts == {"matched": 20, "modified": 17, "inserted": 0, "buckets": len(touched)}  # 0, and nulls of 7 and 14, are the same
    assert {b for b in before.held if before.held[b] != after.held[b]} == touched and len(touched) < 25
    folder = f"{root}/users/{buckets.DATA}"
    written = {n for n in os.listdir(folder) if n.endswith(".parquet")} - {n for names in before.held.values() for n in names}
    assert {int(buckets._BUCKET.search(n)[1]) for n in written} == touched and len(written) == len(touched)
    want = rows(spark, 20_000).join(changes.select("key"), "key", "left_anti").unionByName(changes)
    assert as_set(buckets.read(spark, root, "users").select("key", "v", "w")) == as_set(want.select("key", "v", "w"))


def test_the_target_is_not_shuffled(spark, root):
    table = buckets.current(spark, root, "users")
    target = buckets._bucketed(spark, table, table.held)
    merged = buckets._merged(target, rows(spark, 20), ["key"], True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    few = buckets._bucketed(spark, table, {3: table.held[3]})
    assert {r[0] for r in few.select(buckets.bucket_of(["key"], 64)).distinct().collect()} == {3}
    assert len(few.select("_metadata.file_name").distinct().collect()) == 1
    grouped = buckets.read(spark, root, "users", bucketed=True).groupBy("key").count()
    assert "Exchange hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.count() == 20_000


def test_inserts_nulls_and_missing_columns(spark, root):
    changes = spark.createDataFrame([("k1", None), ("new", 5), ("k2", 2)], "key string, v int")
    assert buckets.upsert(changes, root, "users", insert=False) == {"matched": 2, "modified": 1, "inserted": 0, "buckets": 3}
    assert buckets.upsert(changes, root, "users") == {"matched": 2, "modified": 0, "inserted": 1, "buckets": 3}
    got = {r.key: (r.v, r.w) for r in buckets.read(spark, root, "users").where("key in ('k1', 'k2', 'new')").collect()}
    assert got == {"k1": (None, "x"), "k2": (2, "x"), "new": (5, None)}
    assert buckets.read(spark, root, "users").count() == 20_001


def test_what_is_refused(spark, root):
    for bad, message in (
        (spark.createDataFrame([(None, 1)], "key string, v int"), "without"),
        (spark.createDataFrame([("a", 1), ("a", 2)], "key string, v int"), "several"),
        (spark.createDataFrame([("a", 1)], "key string, z int"), "no columns"),
        (spark.createDataFrame([(1,)], "v int"), "need the keys"),
    ):
        with pytest.raises(ValueError, match=message):
            buckets.upsert(bad, root, "users")
    with pytest.raises(ValueError, match="no bucketed table"):
        buckets.read(spark, root, "others")
    assert snapshots.numbers(spark, f"{root}/users") == [1]


def test_a_killed_upsert_leaves_the_rows_before(spark, root, monkeypatch):
    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(files, "move", killed)
        with pytest.raises(RuntimeError, match="killed"):
            buckets.upsert(rows(spark, 20, factor=-1), root, "users")
    assert as_set(buckets.read(spark, root, "users")) == as_set(rows(spark, 20_000))
    buckets.upsert(rows(spark, 20, factor=-1), root, "users")
    assert buckets.read(spark, root, "users").where("v < 0").count() == 17
    assert buckets.read(spark, root, "users", number=1).where("v < 0").count() == 0
    assert buckets.expire(spark, root, "users", timedelta(hours=1)) == 0
    assert buckets.expire(spark, root, "users", timedelta(0)) > 0
    assert buckets.read(spark, root, "users").count() == 20_000


def test_no_rows(spark, tmp_path):
    buckets.create(rows(spark, 0), str(tmp_path), "none", ["key"], 4)
    assert buckets.read(spark, str(tmp_path), "none").collect() == []
    assert buckets.upsert(rows(spark, 0), str(tmp_path), "none")["buckets"] == 0
    assert buckets.upsert(rows(spark, 3), str(tmp_path), "none")["inserted"] == 3
    assert as_set(buckets.read(spark, str(tmp_path), "none")) == as_set(rows(spark, 3))
