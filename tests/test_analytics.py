from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from userflow.operators import analytics

NOON = datetime(2024, 1, 1, 12)
ROWS = [
    ("m", 10, "A", NOON),
    ("m", None, "A", NOON + timedelta(seconds=59)),
    ("f", 20, "A", NOON + timedelta(seconds=60)),
    (None, None, "B", NOON + timedelta(seconds=61)),
    ("f", 30, None, None),
]


@pytest.fixture(scope="module")
def users(spark):
    schema = "gender string, age int, country string, processed_timestamp timestamp"
    return spark.createDataFrame(ROWS, schema)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_counts_keep_null_groups(users):
    assert as_set(analytics.gender_distribution(users)) == {("m", 2), ("f", 2), (None, 1)}
    assert as_set(analytics.country_distribution(users)) == {("A", 3), ("B", 1), (None, 1)}


def test_mean_ignores_null_ages_but_count_does_not(users):
    means = as_set(analytics.avg_age_by_country(users))
    assert means == {("A", 15.0, 3), ("B", None, 1), (None, 30.0, 1)}


def test_age_totals_and_counts_per_batch(users):
    assert as_set(analytics.age_distribution(users)) == {
        ("0-17", 1), ("65+", 2), ("18-24", 1), ("25-34", 1),
    }
    per_batch = analytics.age_distribution(users, per_batch=True)
    assert per_batch.columns == ["age_group", "count", "timestamp"]
    assert per_batch.count() == 5


def test_inflow_windows_leave_out_rows_without_a_time(users):
    minute = timedelta(minutes=1)
    assert as_set(analytics.user_inflow(users)) == {
        (NOON, NOON + minute, 2),
        (NOON + minute, NOON + 2 * minute, 2),
    }


def test_stamp_is_added_after_aggregation(users):
    stamped = analytics.all_analytics(users, as_of=F.lit(NOON))
    assert list(stamped) == list(analytics.NEEDS)
    for name, result in stamped.items():
        assert result.columns[-1] == "timestamp", name
        assert {r.timestamp for r in result.collect()} == {NOON}


def test_one_pass_equals_the_single_results(users):
    combined = analytics.analytics_in_one_pass(users)
    for name, result in analytics.all_analytics(users).items():
        picked = analytics.pick_result(combined, name)
        assert picked.columns == result.columns
        assert as_set(picked) == as_set(result), name
