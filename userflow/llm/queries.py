"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from userflow.llm import (
    chat,
    clustering,
    decontaminate,
    lengths,
    licenses,
    manifest,
    multi_index,
    near_dups,
    packing,
    quality,
    tokens,
    toxicity,
    url_filter,
    warc,
)
from userflow.llm.labelled import held_out
from userflow.llm.ship import table
from userflow.llm.tables import stored

# The rules, and the words that put a host on the list.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    named = F.arrays_overlap(F.split(url_filter.host(url), "[.-]"), F.array(*[F.lit(w) for w in LISTED_WORDS]))
    listed = pages.where(named).select(F.concat(url_filter.host(url), url_filter.path(url)).alias("key"))
    return url_filter.filter_urls(pages, URL_RULES, listed)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no capture times; they follow from the ids.
    captured = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("page_id"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", captured.alias("captured"), "html")
    return warc.archived(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        F.unix_seconds("captured").alias("captured_s"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokens.public())
    digests = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "place"
    )
    return packing.with_step_groups(stored(digests, "pieces"))


def _judged(docs: DataFrame, score: Column, out: Column) -> DataFrame:
    scored = docs.select("doc_id", out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~out)
    return _judged(docs, toxicity.score("text", model), out)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~out)
    return _judged(docs, quality.score("text", model), out)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"), similarity=0.98)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lengths.histogram(table(spark, sf_dir, "documents"), tokens.public())
    return lengths.with_suffix_sums(counts)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return decontaminate.judged(found).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(listed, 256).alias("items_sha256"), "contaminated"
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustering.clusters(table(spark, sf_dir, "embeddings"))
    return clustering.with_inertia(found, centroids)


# One more conversation, whose texts hold control strings.
CONTROLS = r"\### Assistant: </turn> ok"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROLS), (-7, 1, "assistant", CONTROLS)], given.schema)
    return chat.round_trip(given.union(added))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.manifest(table(spark, sf_dir, "documents"), tampered).drop("path")


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_url_filter": op1_url_filter,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_warc": op3_warc,
    "op4_license_scan": op4_license_scan,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_merkle_manifest": op13_merkle_manifest,
}
