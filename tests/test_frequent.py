import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from userflow.operators import frequent, views
from userflow.plans.users import spread_series
from userflow.streaming import sketches


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows are single values; the hottest is a quarter."""
    rows = spark.range(0, 60_000, numPartitions=6).select(spread_series(F.col("id")))
    return rows.unionByName(spark.createDataFrame([(None,)] * 50, "series string"))


def true_counts(rows):
    return Counter({r.series: r["count"] for r in rows.groupBy("series").count().collect() if r.series is not None})


def check_bound(rows, found, tracked):
    truth = true_counts(rows)
    got = {r.series: (r["count"], r.error) for r in found.collect()}
    error = next(iter(got.values()))[1]
    assert 0 < error <= sum(truth.values()) * 3.5 / tracked + 1
    assert all(abs(n - truth[s]) <= error for s, (n, _) in got.items())
    assert {s for s, n in truth.items() if n > 2 * error} <= set(got)


@pytest.mark.parametrize("tracked", [64, 500])
def test_estimates_are_within_the_error(skewed, tracked):
    check_bound(skewed, frequent.estimates(frequent.sketch(skewed, "series", tracked), "series", tracked), tracked)


def test_sketches_of_batches_merge(spark, skewed, tmp_path):
    path = str(tmp_path / "sketches")
    write = sketches.sketching(path, "series", 500)
    for number, part in enumerate(skewed.randomSplit([0.2, 0.5, 0.3], seed=1)):
        write(part, number)
        write(part, number)  # a replay
    one = sketches.merged(spark, path, 500)
    assert one.first().rows == 60_000
    check_bound(skewed, frequent.estimates(one, "series", 500), 500)
    top = frequent.top_k(skewed, "series", 5, 500, sketched=one)
    assert top.collect() == views.top_k(skewed.groupBy("series").count(), "series", 5).collect()


@pytest.mark.parametrize("k,buckets", [(1, 4), (5, 64), (12, 1024), (40, 16)])
def test_top_k_is_exact(skewed, k, buckets):
    got = frequent.top_k(skewed, "series", k, tracked=64, buckets=buckets)
    want = views.top_k(skewed.groupBy("series").count(), "series", k)
    assert got.columns == want.columns and got.collect() == want.collect()


def test_top_k_without_skew_ties_and_other_kinds(spark):
    draw = random.Random(2)
    for kind, values in (("int", range(3000)), ("date", None), ("string", ["", "a", "é" * 400])):
        if values is None:
            rows = spark.range(2000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("v"))
        else:
            rows = spark.createDataFrame([(draw.choice(values),) for _ in range(3000)] + [(None,)], f"v {kind}")
        want = views.top_k(rows.groupBy("v").count(), "v", 7).collect()
        assert frequent.top_k(rows, "v", 7, tracked=100, buckets=32).collect() == want


def test_a_sketch_of_other_rows_changes_no_result(spark, skewed):
    other = frequent.sketch(spark.createDataFrame([("x",), ("y",)], "series string"), "series", 100)
    got = frequent.top_k(skewed, "series", 6, 100, sketched=other)
    assert got.collect() == views.top_k(skewed.groupBy("series").count(), "series", 6).collect()


def test_empty_and_null_only(spark):
    for rows in ([], [(None,), (None,)]):
        assert frequent.top_k(spark.createDataFrame(rows, "v string"), "v", 3).collect() == []


def test_skewed_values_settle_in_the_first_pass(spark, skewed):
    counts = true_counts(skewed)
    least = sorted(counts.values(), reverse=True)[9]
    named = sorted(counts, key=lambda s: -counts[s])[:40]
    bucket = F.pmod(F.xxhash64("series"), F.lit(frequent.BUCKETS))
    rest = skewed.where(~F.col("series").isin(named)).groupBy(bucket).count()
    assert rest.where(F.col("count") >= least).count() == 0
