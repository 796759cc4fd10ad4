"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine is designed for. A caller's own session works as well.
SETTINGS = {
    # Re-plan at run time: join strategy, partition count, split of skewed keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stored times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # State beyond executor memory: on local disk, with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "userflow",
    settings: dict[str, str] | None = None,
    packages: str | None = None,
) -> SparkSession:
    """A session with the engine's settings; ``packages`` names the connector to
    load for topic reads and writes. Master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder the session names.

    Only a local session that names none gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="userflow-"))
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/userflow/{purpose}-{uuid.uuid4().hex}"
