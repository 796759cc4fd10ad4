"""Properties that must hold whatever the size of the data."""

import glob
import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import userflow
from userflow.operators import analytics
from userflow.operators.parse import parse_users, with_event_time
from userflow.plans import batch
from userflow.plans.users import user_records
from userflow.session import scratch
from userflow.sources import tables
from userflow.streaming import pipeline

PACKAGE = os.path.dirname(userflow.__file__)


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def final_plan(df, capsys):
    df.collect()
    return plan(df, capsys).split("Initial Plan")[0]


def sources():
    """All of the library but the optional training-data operators."""
    paths = glob.glob(f"{PACKAGE}/**/*.py", recursive=True)
    return [path for path in paths if not path.startswith(f"{PACKAGE}/llm/")]


@pytest.mark.parametrize(
    "pattern",
    [r"\.collect\(", r"toPandas", r"localCheckpoint", r"\budf\b", r"\.rdd\b", r"crossJoin",
     r"broadcast\(", r"coalesce\(1\)", r"toLocalIterator"],
)
def test_library_code_stays_distributed(pattern):
    hits = [path for path in sources() if re.search(pattern, open(path).read())]
    assert not hits


LAZY = [
    name
    for name in batch.QUERIES
    if name not in {"append_users", "replace_result", "upsert_users", "user_inflow_recent"}
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_cross_join_python_or_single_task_window(spark, small_dir, capsys, name):
    text = plan(batch.QUERIES[name](spark, small_dir), capsys)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window ["):
        assert node not in text, node


@pytest.mark.parametrize("name", list(analytics.NEEDS))
def test_rows_are_combined_before_the_only_shuffle(spark, small_dir, capsys, name):
    text = plan(batch.QUERIES[name](spark, small_dir), capsys)
    assert "partial_" in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_messages_are_decoded_once(spark, tmp_path, capsys):
    spark.createDataFrame([], "value binary").write.parquet(f"{tmp_path}/t")
    messages = spark.read.parquet(f"{tmp_path}/t")
    users = parse_users(messages, fields=("gender", "age", "country", "timestamp"))
    timed = with_event_time(users)
    for result in (*analytics.all_analytics(timed, time_col="timestamp").values(),
                   analytics.analytics_in_one_pass(timed, "timestamp")):
        assert plan(result, capsys).count("from_json(") == 1


def test_only_needed_fields_are_decoded(spark, tmp_path, capsys):
    spark.createDataFrame([], "value binary").write.parquet(f"{tmp_path}/t")
    results = pipeline.topic_results(spark.read.parquet(f"{tmp_path}/t"), parse="declared")
    text = plan(results["avg_age_by_country"], capsys)
    assert "StructField(age,IntegerType,true)" in text
    assert "email" not in text and "city" not in text
    text = plan(results["user_inflow"], capsys)
    assert "from_json" not in text and "ReadSchema: struct<>" in text


SPLIT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4KB",
    "spark__sql__files__maxPartitionBytes": "16KB",
    "spark__sql__shuffle__partitions": "8",
}


@pytest.fixture(scope="module")
def hot_dir(spark, small_dir, tmp_path_factory):
    """The small tables, but one user stands behind a third of the events."""
    base = str(tmp_path_factory.mktemp("hot"))
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).cast("bigint")
    events.withColumn("user_id", hot).repartition(16).write.parquet(f"{base}/events.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"{small_dir}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    return base


def test_a_user_behind_a_third_of_the_events_is_split(spark, hot_dir, capsys):
    want = sorted(map(tuple, user_records(spark, hot_dir).collect()), key=str)
    with settings(spark, **SPLIT):
        users = user_records(spark, hot_dir)
        text = final_plan(users, capsys)
        got = sorted(map(tuple, users.collect()), key=str)
    assert "SortMergeJoin(skew=true)" in text
    assert got == want


def test_a_key_shared_by_a_third_of_the_target_is_split(spark, capsys):
    target = spark.range(0, 30000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    updates = spark.range(0, 30000, 2, 4).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    with settings(spark, **SPLIT):
        merged = tables.merge_rows(target, updates, ["k"], insert=True)
        text = final_plan(merged, capsys)
        counts = {r._merge: r["count"] for r in merged.groupBy("_merge").count().collect()}
    assert "SortMergeJoin(skew=true)" in text
    # Even numbers are updated; multiples of 3 all became key 0, whose update is v = 0.
    assert counts == {"modified": 19999, "same": 1, "untouched": 10000, "inserted": 4999}


def test_updates_that_fit_a_broadcast_leave_the_target_unshuffled(spark, tmp_path, capsys):
    schema = "k long, v long"
    spark.range(100).selectExpr("id as k", "id as v").write.parquet(f"{tmp_path}/t")
    target = spark.read.schema(schema).parquet(f"{tmp_path}/t")
    spark.range(5).selectExpr("id as k", "id as v").write.parquet(f"{tmp_path}/u")
    updates = spark.read.schema(schema).parquet(f"{tmp_path}/u")
    text = plan(tables.merge_rows(target, updates, ["k"]), capsys)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a").startswith(f"{shared}/userflow/a-")
    assert scratch(spark, "a") != scratch(spark, "a")
