"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from userflow.session import scratch


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs its own tasks, not the steps before. The
    folder is the owner's to clear once the results that read it are written.
    """
    spark = df.sparkSession
    path = scratch(spark, f"llm/{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def free(df: DataFrame, name: str) -> str:
    """A name for a helper column, like ``name``, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
