"""The training-data pipeline: stages over documents, each written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.llm import decontaminate, near_dups, packing, quality, toxicity
from userflow.llm.ship import table
from userflow.llm.tables import stored
from userflow.llm.tokens import public

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, learnt from all labels, lets pass."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking, learnt from all labels, puts above its cut."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, 0.8."""
    return near_dups.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable part of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents left, with their step groups."""
    pieces = packing.pack(docs, public()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.with_step_groups(stored(pieces, "pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Classifiers and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
