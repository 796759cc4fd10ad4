"""Exact length histogram of encoded documents and what it answers for every limit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm.tables import stored
from userflow.llm.tokens import Vocabulary, encoder

BLOCK = 1 << 10  # lengths that share a block of the suffix sums


def encoded_length(text: Column | str, vocabulary: Vocabulary) -> Column:
    """Number of ids of a text; 0 for a null or empty one."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        own = encoder(vocabulary)
        return pa.array(np.fromiter((len(own.ids(t.as_py())) for t in texts), np.int64, len(texts)))

    return counted(text)


def histogram(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """(length, n_docs) over all rows, null texts and repeated rows included."""
    lengths = docs.select(encoded_length(F.col(text), vocabulary).alias("length"))
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """Per length of a histogram, taken as a context limit: n_docs of that length,
    docs_at_least and tokens_at_least (documents that long or longer, and all their
    tokens), truncated_tokens (all documents cut at the limit), share_up_to (part of the
    documents that fit whole). Empty for an empty histogram.

    Sums run within blocks of lengths and over blocks, so that no task sees every length.
    """
    counts = counts.select("length", "n_docs", F.expr(f"length div {BLOCK}").alias("block"))
    counts = stored(counts, "lengths")
    blocks = counts.groupBy("block").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("length")).alias("tokens")
    )
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(longer), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_beyond"),
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("tokens").over(everything).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.join(blocks, "block").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(within) + F.col("docs_beyond")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("length")).over(within) + F.col("tokens_beyond")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    shorter = F.col("all_tokens") - F.col("tokens_at_least")
    return sums.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (shorter + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("share_up_to"),
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens of all documents cut at ``limit``, and the documents cut; null for
    an empty histogram. Any limit is answered from the histogram with its sums."""
    cut = F.col("length") > limit
    kept = F.sum(F.when(cut, limit).otherwise(F.col("length")) * F.col("n_docs"))
    return sums.agg(kept.alias("tokens"), F.sum(F.when(cut, F.col("n_docs")).otherwise(0)).alias("docs_cut"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents don't exceed."""
    return sums.where(F.col("share_up_to") >= share).agg(F.min("length").alias("length"))
