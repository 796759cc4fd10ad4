from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from userflow.operators import views

START = datetime(2024, 1, 1)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_series_is_trailing_and_ordered(spark):
    rows = [(START + timedelta(minutes=i), i) for i in (9, 11, 3, 5, 60, 4, 10)]
    inflow = frame(spark, "window_start timestamp, count long", *rows)
    series = views.inflow_series(inflow, F.lit(START + timedelta(minutes=10)))
    assert [r["count"] for r in series.collect()] == [5, 9, 10]


def test_share_of_total(spark):
    counts = frame(spark, "gender string, count long", ("m", 1), ("f", 2), (None, 1))
    rows = views.share(counts).collect()
    assert {r.gender: r.percent for r in rows} == {"m": 25.0, "f": 50.0, None: 25.0}


def test_share_of_nothing(spark):
    zero = frame(spark, "gender string, count long", ("m", 0))
    assert views.share(zero).first().percent is None
    assert views.share(zero.where("false")).collect() == []


def test_latest_skips_nulls(spark):
    rows = frame(
        spark, "gender string, count long, timestamp int",
        ("m", 1, 1), ("m", 2, 2), ("m", None, 3), ("f", 7, 1),
    )
    assert {tuple(r) for r in views.latest(rows, "gender").collect()} == {("m", 2), ("f", 7)}


def test_bars_add_up_batches_in_bracket_order(spark):
    rows = frame(
        spark, "age_group string, count long, timestamp int",
        ("65+", 1, 1), ("0-17", 2, 1), ("65+", 3, 2), ("18-24", 1, 2),
    )
    bars = [(r.age_group, r["count"]) for r in views.bracket_bars(rows).collect()]
    assert bars == [("0-17", 2), ("18-24", 1), ("65+", 4)]


def test_top_k_ties_and_nulls(spark):
    rows = [("B", 2), ("A", 2), (None, 9), ("C", 5), ("D", 1)]
    counts = frame(spark, "country string, count long", *rows)
    assert [tuple(r) for r in views.top_k(counts, k=3).collect()] == [("C", 5), ("A", 2), ("B", 2)]
    with_null = views.top_k(counts, k=1, with_null=True).collect()
    assert [tuple(r) for r in with_null] == [(None, 9)]


def test_total(spark):
    counts = frame(spark, "country string, count long", ("A", 2), (None, 3))
    assert views.total(counts).first().total == 5


@pytest.mark.parametrize("value,color", [(79.9, "green"), (80.0, "red"), (None, "green")])
def test_band(spark, value, color):
    assert frame(spark, "v double", (value,)).select(views.band("v")).first()[0] == color


MEANS = "country string, avg_age double, count long"


def test_markers_scale_linearly(spark):
    means = frame(spark, MEANS, ("A", 20.0, 10), ("B", None, 20), ("C", 40.0, 30))
    rows = {r.country: (r["size"], r.heat, r.band) for r in views.markers(means).collect()}
    assert rows == {
        "A": (2.0, 0.0, "green"),
        "B": (8.5, None, "green"),
        "C": (15.0, 1.0, "green"),
    }


def test_markers_of_equal_rows(spark):
    means = frame(spark, MEANS, ("A", 90.0, 3), ("B", 90.0, 3))
    rows = {tuple(r)[3:] for r in views.markers(means).collect()}
    assert rows == {(2.0, 0.0, "red")}
