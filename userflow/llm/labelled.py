"""Labelled documents to learn from: a bounded sample, the same for the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm.tables import stored


LONG = 64 << 10  # bytes of a long text


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document's label is kept for testing: crc32 of its id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, learns: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` documents of ``docs`` (doc_id, text) with
    a 0 or 1 in ``label``, for which ``learns`` holds: those with the smallest hashes of
    their ids. Ids labelled both ways, null ids and null labels are left out; of rows that
    share an id the least text is taken."""
    present = _present(docs, labels, label, learns)
    return _with_text(docs, stored(_first(present, rows), "labelled"))


def sample_by_class(docs: DataFrame, labels: DataFrame, label: str, learns: Column, rows: int) -> tuple[DataFrame, float]:
    """As ``sample``, half of the rows of each class, more of one where the other has
    fewer; and the share of ones among all labelled documents."""
    present = stored(_present(docs, labels, label, learns), "labelled-all")
    held = {r["label"]: r["n"] for r in present.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(held.values())
    chosen = present.limit(0)
    for value, own in held.items():
        most = max(rows // 2, rows - (n - own))
        chosen = chosen.union(_first(present.where(F.col("label") == F.lit(value)), most))
    ones = sum(own for value, own in held.items() if float(value) == 1)
    return _with_text(docs, stored(chosen, "labelled")), ones / max(n, 1)


def within(taken: DataFrame, most_bytes: int) -> DataFrame:
    """As many of the sampled texts as have ``most_bytes`` together, the same part for each
    label. Long texts are left out first, so that few are; a sample is small enough for its
    sizes to be added up by label in one task each."""
    labels = taken.select("label").distinct().count()
    size = F.octet_length(F.coalesce("text", F.lit("")))
    order = Window.partitionBy("label").orderBy(F.floor(size / LONG), F.xxhash64("doc_id"), "doc_id")
    sizes = taken.select("doc_id", "label", F.sum(size).over(order).alias("running"))
    kept = sizes.where(F.col("running") <= most_bytes // max(labels, 1)).select("doc_id")
    return taken.join(kept, "doc_id", "left_semi")


def known(labels: DataFrame, label: str, learns: Column) -> DataFrame:
    """(doc_id, label) of each id with a 0 or 1 in ``label``, and not both, for which
    ``learns`` holds."""
    there = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learns)
    there = there.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("most"))
    return there.where("label = most").select("doc_id", "label")


def _present(docs: DataFrame, labels: DataFrame, label: str, learns: Column) -> DataFrame:
    return docs.select("doc_id").join(known(labels, label, learns), "doc_id").select("doc_id", "label").distinct()


def _first(present: DataFrame, rows: int) -> DataFrame:
    return present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _with_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    texts = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return stored(texts.select("doc_id", "text", "label"), "labelled-texts")
