import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from userflow.sources import skipping, snapshots, tables
from userflow.sources.skipping import Between


def rows(spark, n, first=0):
    number = F.col("id")
    return spark.range(first, first + n).select(
        F.concat(F.lit("u-"), number.cast("string")).alias("id"),
        F.when(number % 50 != 0, (number % 100).cast("int")).alias("age"),
        F.concat(F.repeat(F.lit("é"), 70), (number % 100).cast("string")).alias("long"),
        (number / 8).alias("share"),
        F.timestamp_seconds(number * 60).alias("ts"),
        F.lit(None).cast("string").alias("nothing"),
    )


@pytest.fixture
def root(spark, tmp_path):
    made = skipping.clustered(rows(spark, 10_000), ["age"], 16)
    tables.replace(made, str(tmp_path), "users")
    skipping.index(spark, str(tmp_path), "users", ["age", "long", "share", "ts", "nothing"], ["id", "age", "share", "nothing"])
    return str(tmp_path)


def opened(frame):
    """Files that a read opened, by the scan's own count."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves, found = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        found += metric.get().value() if metric.isDefined() else 0
    return found


CASES = [
    {"age": 17},
    {"age": None},
    {"age": [3, None]},
    {"age": Between(40, 45)},
    {"age": Between(high=4)},
    {"age": Between()},
    {"age": 1000},
    {"age": 10**12},
    {"age": Between(low=10**12)},
    {"age": Between(high=10**12)},
    {"age": []},
    {"id": "u-77"},
    {"id": ["u-77", "u-9999", "none"]},
    {"id": "none"},
    {"id": "u-77", "age": 78},
    {"id": ["u-77", None], "age": Between(70, 80)},
    {"share": 1.25},
    {"share": [-0.0, math.nan]},
    {"long": "é" * 70 + "5"},
    {"long": Between(low="é" * 70 + "98")},
    {"ts": Between(datetime(1970, 1, 2), datetime(1970, 1, 2, 1))},
    {"nothing": None},
    {"nothing": "x"},
    {"nothing": Between("a", "b")},
    {},
]


@pytest.mark.parametrize("where", CASES, ids=str)
def test_the_rows_are_those_of_a_whole_read(spark, root, where):
    got = skipping.find(spark, root, "users", where, ["id", "age"])
    want = tables.table(spark, root, "users").where(skipping.condition(where)).select("id", "age")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.columns == ["id", "age"]


def test_files_opened_fall_with_the_predicate(spark, root):
    def n(where):
        return opened(skipping.find(spark, root, "users", where))

    assert n({}) == 16 and n({"ts": Between(datetime(1970, 1, 1))}) == 16
    assert n({"age": Between(0, 49)}) <= 9
    assert n({"age": 17}) <= 2 and n({"age": None}) == 1
    assert n({"id": "u-77"}) <= 2 and n({"id": [f"u-{i}" for i in (1, 101, 201)]}) <= 4
    assert n({"age": 1000}) == n({"nothing": "x"}) == 0


def test_filters_let_few_files_through_by_chance(spark, root):
    met = [len(skipping.files_of(spark, root, "users", {"id": f"other-{i}"})) for i in range(12)]
    assert sum(met) <= 16  # 1.4 % of 192, with room


def test_files_without_a_note_are_read(spark, root):
    tables.append(rows(spark, 10, first=20_000), root, "users")
    got = skipping.find(spark, root, "users", {"id": ["u-20003", "u-3"]})
    assert {r.id for r in got.collect()} == {"u-20003", "u-3"}
    fresh = skipping.files_of(spark, root, "users", {"id": "none"})
    skipping.index(spark, root, "users", ["age"], ["id"])
    assert fresh and len(skipping.files_of(spark, root, "users", {"id": "none"})) < len(fresh)


def test_notes_on_another_version_go_unused(spark, root):
    tables.replace(rows(spark, 100, first=50_000), root, "users")
    assert skipping.files_of(spark, root, "users", {"age": 1}) is None
    assert skipping.find(spark, root, "users", {"age": 1}).count() == 1
    skipping.index(spark, root, "users", ["age"])
    assert skipping.files_of(spark, root, "users", {"age": 1000}) == []


def test_notes_on_changed_files_go_unused(spark, root):
    base = f"{root}/users/{skipping.NOTES}"
    newest = snapshots.latest(spark, base)
    assert skipping.files_of(spark, root, "users", {"age": 1000}) == []
    other = spark.read.parquet(newest.path("files")).withColumn("file_size", F.col("file_size") + 1)
    snapshots.publish(spark, base, {"files": tables.stage(other, base, "files")}, info=newest.info)
    assert len(skipping.files_of(spark, root, "users", {"age": 1000})) == 16


def test_wide_predicates_read_the_table_as_it_is(spark, root, monkeypatch):
    monkeypatch.setattr(skipping, "MOST_FILES", 3)
    assert skipping.files_of(spark, root, "users", {"age": Between(0, 90)}) is None
    assert skipping.find(spark, root, "users", {"age": Between(0, 90)}).count() == 9000 - 100


def test_empty_tables_and_dates(spark, tmp_path):
    root = str(tmp_path)
    tables.replace(rows(spark, 0), root, "none", make=True)
    skipping.index(spark, root, "none", ["age"], ["id"])
    assert skipping.find(spark, root, "none", {"id": "u-1"}).count() == 0
    tables.upsert_dated(rows(spark, 5000), root, "dated", ["id", "ts"], "ts")
    skipping.index(spark, root, "dated", ["ts"], ["id"])
    got = skipping.find(spark, root, "dated", {"id": ["u-1", "u-4999"]}, ["id"])
    assert {r.id for r in got.collect()} == {"u-1", "u-4999"} and opened(got) <= 3


def test_one_key_spreads_over_files(spark, tmp_path):
    hot = rows(spark, 9000).withColumn("age", F.lit(1))
    sizes = skipping.clustered(hot, ["age"], 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 3000
