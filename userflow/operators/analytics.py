"""The five user analytics, for batch and streaming frames alike.

All aggregates are algebraic: Spark combines rows per key on the map side, so a
key that holds a large part of the input reaches its reducer as one row per map
task.

No function reads a clock. ``as_of`` adds the ``timestamp`` column of the result;
a pipeline passes ``F.current_timestamp()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.functions.brackets import age_bracket

# What each result needs from a user record.
NEEDS = {
    "gender_distribution": ("gender",),
    "age_distribution": ("age",),
    "country_distribution": ("country",),
    "user_inflow": (),
    "avg_age_by_country": ("age", "country"),
}


def gender_distribution(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Users per gender; a null gender is a group of its own."""
    return _stamped(users.groupBy("gender").agg(_rows()), as_of)


def age_distribution(
    users: DataFrame,
    per_batch: bool = False,
    batch_col: str = "processed_timestamp",
    unknown_label: str | None = None,
    watermark: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Users per age bracket.

    With ``per_batch`` the batch time is a second key and becomes ``timestamp``:
    counts of different micro-batches never merge, so the result grows by up to
    seven rows per batch. So does the state, unless a watermark closes past batches
    in ``append`` or ``update`` mode. The default keeps running totals.
    """
    bracket = age_bracket("age", unknown_label).alias("age_group")
    if per_batch:
        if users.isStreaming and watermark is not None:
            users = users.withWatermark(batch_col, watermark)
        return users.groupBy(bracket, F.col(batch_col).alias("timestamp")).agg(
            F.sum(F.lit(1)).alias("count")
        ).select("age_group", "count", "timestamp")
    return _stamped(users.groupBy(bracket).agg(F.sum(F.lit(1)).alias("count")), as_of)


def country_distribution(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Users per country; a null country is a group of its own."""
    return _stamped(users.groupBy("country").agg(_rows()), as_of)


def avg_age_by_country(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Mean age and number of users per country.

    ``count`` counts all users, the mean only those with a known age, so ``count``
    is not the denominator of ``avg_age``.
    """
    means = users.groupBy("country").agg(F.avg("age").alias("avg_age"), _rows())
    return _stamped(means, as_of)


def user_inflow(
    users: DataFrame,
    time_col: str = "processed_timestamp",
    window: str = "1 minute",
    watermark: str | None = "1 minute",
    as_of: Column | None = None,
) -> DataFrame:
    """Users per tumbling window of ``time_col``; rows without a time have none.

    On a stream the watermark drops late rows and frees state in ``append`` and
    ``update`` mode only. ``complete`` mode keeps every window and every late row.
    """
    if users.isStreaming and watermark is not None:
        users = users.withWatermark(time_col, watermark)
    counted = users.groupBy(F.window(time_col, window)).agg(_rows())
    return _stamped(
        counted.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "count",
        ),
        as_of,
    )


def all_analytics(
    users: DataFrame,
    per_batch: bool = False,
    time_col: str = "processed_timestamp",
    window: str = "1 minute",
    watermark: str | None = "1 minute",
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """The five results by name, each a lazy frame over the same users."""
    return {
        "gender_distribution": gender_distribution(users, as_of),
        "age_distribution": age_distribution(
            users, per_batch, watermark=watermark, as_of=as_of
        ),
        "country_distribution": country_distribution(users, as_of),
        "user_inflow": user_inflow(users, time_col, window, watermark, as_of),
        "avg_age_by_country": avg_age_by_country(users, as_of),
    }


def analytics_in_one_pass(
    users: DataFrame,
    time_col: str | None = "processed_timestamp",
    unknown_label: str | None = None,
) -> DataFrame:
    """All results from a single scan, as one long frame keyed by ``result``.

    Five separate results read and parse the source five times. Grouping sets do
    it once: every row is counted under its gender, bracket, country and minute
    before the shuffle, which then carries one row per key and map task.
    ``pick_result`` gives the single results back. Without a ``time_col`` there is no
    inflow among them.
    """
    keys = ["gender", "age_group", "country"]
    bracket = age_bracket("age", unknown_label).alias("age_group")
    columns = [F.col("gender"), bracket, F.col("country")]
    if time_col is not None:
        kind = users.schema[time_col].dataType
        minute = F.date_trunc("minute", F.col(time_col)).cast(kind)
        keys.append("window_start")
        columns.append(minute.alias("window_start"))
    counted = (
        users.select(*columns, "age")
        .groupingSets([[F.col(k)] for k in keys], *(F.col(k) for k in keys))
        .agg(
            _rows(),
            F.avg("age").alias("avg_age"),
            *(F.grouping(k).alias(f"no_{k}") for k in keys),
        )
    )
    result = (
        F.when(F.col("no_gender") == 0, "gender_distribution")
        .when(F.col("no_age_group") == 0, "age_distribution")
        .when(F.col("no_country") == 0, "avg_age_by_country")
        .otherwise("user_inflow")
    )
    windows = []
    if time_col is not None:
        # A row without a time belongs to no window but counts everywhere else.
        timeless = (F.col("no_window_start") == 0) & F.col("window_start").isNull()
        counted = counted.where(~timeless)
        end = F.col("window_start") + F.expr("interval 1 minute")
        windows = [F.col("window_start"), end.alias("window_end")]
    return counted.select(
        result.alias("result"), *keys[:3], *windows, "avg_age", "count"
    )


def pick_result(combined: DataFrame, name: str) -> DataFrame:
    """One named result out of ``analytics_in_one_pass``."""
    columns = {
        "gender_distribution": ["gender", "count"],
        "age_distribution": ["age_group", "count"],
        "country_distribution": ["country", "count"],
        "user_inflow": ["window_start", "window_end", "count"],
        "avg_age_by_country": ["country", "avg_age", "count"],
    }[name]
    stored = "avg_age_by_country" if name == "country_distribution" else name
    columns += [c for c in ("timestamp", "batch_id", "updated_at") if c in combined.columns]
    return combined.where(F.col("result") == stored).select(*columns)


def _rows() -> Column:
    return F.count("*").alias("count")


def _stamped(result: DataFrame, as_of: Column | None) -> DataFrame:
    return result if as_of is None else result.withColumn("timestamp", as_of)
