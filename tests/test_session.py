"""The recommended session in a process of its own, and the scratch folder rules."""

import subprocess
import sys
from types import SimpleNamespace

import pytest

from userflow import session

PROGRAM = """
import sys
from pyspark.sql import functions as F
from userflow.session import build_session
from userflow.sources import tables, topic
from userflow.streaming import pipeline

base = sys.argv[1]
spark = build_session("check", {
    "spark.master": "local[2]", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "2", "spark.driver.host": "localhost",
})
provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
assert provider.endswith("RocksDBStateStoreProvider"), provider
for step in range(2):
    rows = spark.range(10).select(
        F.concat(F.lit('{"age": '), F.col("id") + 15, F.lit("}")).alias("value")
    )
    topic.as_topic_rows(topic.encode_records(rows)).write.mode("append").parquet(f"{base}/topic")
    stream = topic.stream_topic_files(spark, f"{base}/topic")
    pipeline.wait_for(pipeline.run_pipeline(
        stream, f"{base}/tables", f"{base}/checkpoints", every=None, shared_scan=True,
        state_partitions=2,
    ))
ages = tables.table(spark, f"{base}/tables", "age_distribution").collect()
print(sorted((r.age_group, r["count"]) for r in ages))
spark.stop()
"""


def test_recommended_session_runs_and_resumes_a_stream(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, str(tmp_path)],
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.strip().endswith("[('0-17', 6), ('18-24', 14)]")


def fake(shared=None, used=None, master="yarn"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: used)
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default), sparkContext=context
    )


def test_scratch_follows_the_session():
    assert session.scratch(fake("hdfs://a/b/"), "x").startswith("hdfs://a/b/userflow/x-")
    assert session.scratch(fake(used="hdfs://c"), "x").startswith("hdfs://c/userflow/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch(fake(), "x")
