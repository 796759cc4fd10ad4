import random
from datetime import UTC, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from userflow.sources import levels, tables

START = datetime(2019, 12, 30, 22, 13)


def windows(spark, minutes):
    """One window for each (minute, key, count)."""
    rows = [(START + timedelta(minutes=m), k, c) for m, k, c in minutes]
    return spark.createDataFrame(rows, "window_start timestamp_ntz, place string, count bigint")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Windows of three years, few but everywhere, in two batches; the later one also brings
    windows of the first's time."""
    draw = random.Random(5)
    cells = sorted({(draw.randrange(3 * 365 * 1440), draw.choice(["a", "b", None])) for _ in range(4000)}, key=str)
    rows = [(m, k, draw.randrange(1, 50)) for m, k in cells]
    draw.shuffle(rows)
    root = str(tmp_path_factory.mktemp("levels"))
    for part in (rows[:2500], rows[2500:]):
        levels.add(windows(spark, part), root, "inflow", ["place"])
    return root, rows


def ranges():
    draw = random.Random(7)
    for _ in range(4):
        a, b = sorted(draw.randrange(-5000, 3 * 365 * 1440 + 5000) for _ in range(2))
        yield a, b
    yield 100_000, 100_050
    yield -60 * 24 * 4000, 60 * 24 * 4000


@pytest.mark.parametrize("since,until", list(ranges()))
def test_any_range_is_the_sum_of_its_minutes(spark, kept, since, until):
    root, rows = kept
    got = levels.total(spark, root, "inflow", START + timedelta(minutes=since), START + timedelta(minutes=until), ["place"])
    want = {}
    for m, k, c in rows:
        if since <= m < until:
            want[k] = want.get(k, 0) + c
    assert {r.place: r["count"] for r in got.collect()} == want


def test_pieces_are_few_and_cover_the_range_once():
    draw = random.Random(3)
    for _ in range(2000):
        a = draw.randrange(-(10**7), 10**7)
        b = a + draw.choice([0, 1, 59, 60, 1440, draw.randrange(10**7)])
        runs = levels.pieces(a, b)
        assert all(first % step == end % step == 0 and first < end for step, first, end in runs)
        ordered = sorted((first, end) for _, first, end in runs)
        ends = [a, *(end for _, end in ordered)]
        assert [first for first, _ in ordered] == ends[:-1] and ends[-1] == b
        top = levels.STEPS[-1]
        assert levels.blocks(a, b) <= 2 * (59 + 23 + 3 * 7) + (b - a) // top
    assert levels.pieces(0, 0) == levels.pieces(5, 5) == levels.pieces(7, 3) == []


def test_long_ranges_read_few_rows_and_pages(spark, kept):
    root, _ = kept
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    long = levels.total(spark, root, "inflow", START + timedelta(days=3), START + timedelta(days=900, minutes=7))
    assert "PartitionFilters: [isnotnull(row_date" in plan_of(long)
    first, end = (levels._minute(START + t) for t in (timedelta(days=3), timedelta(days=900, minutes=7)))
    whole = tables.table(spark, root, "inflow_1").where(F.col("block").between(first, end - 1)).count()
    read = sum(
        tables.table(spark, root, f"inflow_{step}").where((F.col("block") >= a) & (F.col("block") < b)).count()
        for step, a, b in levels.pieces(first, end)
    )
    assert read <= 3 * levels.blocks(first, end) < 3 * 206 and read < whole / 10


def test_repeats_replace_and_late_windows_count(spark, tmp_path):
    root = str(tmp_path)
    first = windows(spark, [(0, "a", 1), (1, "a", 2), (5000, None, 4)])
    levels.add(first, root, "inflow", ["place"])
    levels.add(first, root, "inflow", ["place"])
    levels.add(windows(spark, [(1, "a", 7), (2, "a", 1)]), root, "inflow", ["place"])
    ever = datetime(1900, 1, 1), datetime(2100, 1, 1)
    got = {r.place: r["count"] for r in levels.total(spark, root, "inflow", *ever, ["place"]).collect()}
    assert got == {"a": 9, None: 4}
    for step in levels.STEPS:
        assert tables.table(spark, root, f"inflow_{step}").agg(F.sum("count")).first()[0] == 13
    levels.add(windows(spark, []), root, "inflow", ["place"])
    no_time = spark.createDataFrame([(None, "a", 5)], "window_start timestamp, place string, count bigint")
    levels.add(no_time, root, "inflow", ["place"])
    assert levels.total(spark, root, "inflow", *ever).first()[0] == 13
    assert levels.total(spark, root, "inflow", ever[0], ever[0]).first()[0] is None


def test_ranges_and_series_in_any_zone(spark, tmp_path):
    root = str(tmp_path)
    rows = windows(spark, [(0, "a", 1), (46, "a", 2), (47, "a", 4)])
    levels.add(rows.groupBy("window_start").agg(F.sum("count").alias("count")), root, "inflow")
    zone = timezone(timedelta(hours=5))
    at = START.replace(tzinfo=UTC).astimezone(zone)
    assert levels.total(spark, root, "inflow", at, at + timedelta(minutes=47)).first()[0] == 3
    # A range takes the windows that start in it.
    assert levels.total(spark, root, "inflow", START + timedelta(microseconds=1), START + timedelta(minutes=46, seconds=1)).first()[0] == 2
    hours = levels.series(spark, root, "inflow", 60, START - timedelta(hours=1), START + timedelta(hours=2))
    got = sorted((str(r.window_start), str(r.window_end), r["count"]) for r in hours.collect())
    assert got == [("2019-12-30 22:00:00", "2019-12-30 23:00:00", 3), ("2019-12-30 23:00:00", "2019-12-31 00:00:00", 4)]
    with pytest.raises(ValueError):
        levels.series(spark, root, "inflow", 7, START, START)
