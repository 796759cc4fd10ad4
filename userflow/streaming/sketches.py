"""Sketches of frequent values, one for each batch of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from userflow.operators import frequent
from userflow.streaming.pipeline import BatchSink


def sketching(path: str, series: str, tracked: int = frequent.TRACKED) -> BatchSink:
    """Keeps the sketch of each batch in a folder of its own, which a replay of it replaces.
    The stream holds no state."""

    def write(batch: DataFrame, batch_id: int) -> None:
        one = frequent.sketch(batch, series, tracked)
        one.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def merged(spark: SparkSession, path: str, tracked: int = frequent.TRACKED) -> DataFrame:
    """The sketch of all batches."""
    return frequent.merge(spark.read.parquet(path), tracked)
