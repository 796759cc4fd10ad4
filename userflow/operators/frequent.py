"""The most frequent values of a column with many of them.

A sketch of bounded size tells which values are frequent, within an error; sketches of batches
merge. ``top_k`` then counts the few that matter and proves by bounded counts that no other
value belongs among them, without keeping a count for each value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.operators import views

TRACKED = 10_000  # values a sketch counts at once
BUCKETS = 16_384  # hash buckets that bound the values a sketch did not name


def sketch(rows: DataFrame, series: str, tracked: int = TRACKED) -> DataFrame:
    """One row, ``state`` and the number of ``rows`` seen; null values are not counted. Each
    task sends one sketch. Not for streams: sketch each batch and ``merge``."""
    known = rows.where(F.col(series).isNotNull())
    state = F.call_function("approx_top_k_accumulate", F.col(series), F.lit(tracked))
    return known.agg(state.alias("state"), F.count(F.lit(1)).alias("rows"))


def merge(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The sketch of all rows that several sketches have seen."""
    state = F.call_function("approx_top_k_combine", F.col("state"), F.lit(tracked))
    return sketches.agg(state.alias("state"), F.sum("rows").alias("rows"))


def estimates(sketched: DataFrame, series: str, tracked: int = TRACKED, k: int | None = None) -> DataFrame:
    """The frequent values by descending estimate, at most ``k``: the value, its ``count``, and
    the ``error`` that no count is off by more than.

    The sketch's map has at least ``tracked / 0.75`` places, and its error is 3.5 of the rows
    by that number. Every value with more than twice the error is named.
    """
    found = _found(min(k or tracked, tracked))
    error = F.ceil(F.col("rows") * 3.5 * 0.75 / tracked)
    each = sketched.select(F.explode(found).alias("found"), error.alias("error"))
    return each.select(F.col("found.item").alias(series), F.col("found.count").alias("count"), "error")


def _found(k: int) -> Column:
    """What a sketch names, as one list."""
    return F.call_function("approx_top_k_estimate", F.col("state"), F.lit(k))


def top_k(
    rows: DataFrame,
    series: str,
    k: int = views.TOP_K,
    tracked: int = TRACKED,
    buckets: int = BUCKETS,
    sketched: DataFrame | None = None,
) -> DataFrame:
    """``views.top_k`` of the rows counted by ``series``: the k most frequent values that are
    not null, exactly; equal counts are ordered by value.

    One pass counts the values that the sketch names first, and all others by hash bucket. No
    value counts more than its bucket, so buckets below the k-th count are settled; a second
    pass counts the values in the others one by one. Where values are skewed there are few
    such buckets or none; where they are alike all values are counted, as the plain query does.
    The driver holds some 4 k values and the bucket counts. ``sketched`` may be a stored
    sketch, also of other rows: it decides on the cost only, never on the result.
    """
    sketched = sketch(rows, series, tracked) if sketched is None else sketched
    named = sketched.select(F.transform(_found(min(4 * k, tracked)), lambda f: f["item"])).first()[0]
    known = rows.where(F.col(series).isNotNull()).select(series)
    is_named = F.col(series).isin(named) if named else F.lit(False)
    bucket = F.pmod(F.xxhash64(series), F.lit(buckets))
    kinds = F.when(is_named, F.col(series)).alias(series), F.when(~is_named, bucket).alias("bucket")
    counted = known.select(*kinds).groupBy(series, "bucket").count()
    lists = (
        F.collect_list(F.when(F.col("bucket").isNull(), F.struct(series, "count"))).alias("first"),
        F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "count"))).alias("others"),
    )
    both = counted.agg(*lists).first()  # one row of at most 4 k and ``buckets`` entries
    largest = sorted((r["count"] for r in both.first), reverse=True)
    least = largest[k - 1] if len(largest) >= k else 0
    open_ = [r.bucket for r in both.others if r["count"] >= least]
    exact = rows.sparkSession.createDataFrame([tuple(r) for r in both.first], _counts(known))
    if open_:
        rest = known.where(~is_named & _among(bucket, open_, buckets))
        exact = exact.unionByName(rest.groupBy(series).count())
    return views.top_k(exact, series, k)


def _among(bucket: Column, some: list[int], buckets: int) -> Column:
    return F.lit(True) if len(some) == buckets else bucket.isin(some)


def _counts(known: DataFrame):
    return known.limit(0).groupBy(*known.columns).count().schema
