"""Dashboard shapes over result tables.

Totals and bounds come from one-row scalar subqueries. A window without a
partition would pull its whole input into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.functions.brackets import bracket_rank

# Default range, marker sizes and the alert threshold of the panels.
TRAILING = "5 minutes"
MARKER_MIN, MARKER_MAX = 2.0, 15.0
ALERT_FROM, BASE_COLOR, ALERT_COLOR = 80, "green", "red"
TOP_K = 10

# Panel titles in layout order.
INFLOW_PANEL = "User Inflow Over Time"
GENDER_PANEL = "Gender Distribution"
AGE_PANEL = "Age Distribution"
COUNTRY_PANEL = "Top Countries by User Count"
MEAN_PANEL = "Average Age by Country"


def inflow_series(
    inflow: DataFrame, as_of: Column, trailing: str = TRAILING
) -> DataFrame:
    """Windows that start within ``trailing`` before ``as_of``, in time order; later
    ones are not shown."""
    since = as_of - F.expr(f"interval {trailing}")
    shown = F.col("window_start").between(since, as_of)
    return inflow.where(shown).orderBy("window_start")


def share(result: DataFrame, value: str = "count") -> DataFrame:
    """Add ``percent``: each row's part of the column total, null if that is 0."""
    whole = result.agg(F.sum(value).cast("double")).scalar()
    return result.withColumn("percent", F.try_divide(F.lit(100.0) * F.col(value), whole))


def latest(
    result: DataFrame, series: str, value: str = "count", time_col: str = "timestamp"
) -> DataFrame:
    """Last non-null value per series."""
    return (
        result.where(F.col(value).isNotNull())
        .groupBy(series)
        .agg(F.max_by(value, time_col).alias(value))
    )


def bracket_bars(ages: DataFrame) -> DataFrame:
    """One bar per age bracket, in bracket order; per-batch rows are added up."""
    bars = ages.groupBy("age_group").agg(F.sum("count").alias("count"))
    return bars.withColumn("position", bracket_rank("age_group")).orderBy("position")


def top_k(
    result: DataFrame,
    series: str = "country",
    k: int = TOP_K,
    value: str = "count",
    with_null: bool = False,
) -> DataFrame:
    """The k largest rows; equal values are ordered by series name."""
    rows = result if with_null else result.where(F.col(series).isNotNull())
    return rows.orderBy(F.desc(value), F.asc(series)).limit(k)


def total(result: DataFrame, value: str = "count") -> DataFrame:
    """Column total, the footer of a table."""
    return result.agg(F.sum(value).alias("total"))


def band(value: Column | str) -> Column:
    """Color of the threshold band a value lies in."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value >= ALERT_FROM, ALERT_COLOR).otherwise(BASE_COLOR)


def markers(
    means: DataFrame, low: float = MARKER_MIN, high: float = MARKER_MAX
) -> DataFrame:
    """Map markers: size linear in ``count``, heat (0 to 1) linear in ``avg_age``.

    When all rows are equal the size is ``low`` and the heat 0. The bounds read the
    same columns as the rows do, so both share one aggregation of the source.
    """
    edge = means.agg(
        F.struct(
            F.min("count").alias("few"),
            F.max("count").alias("many"),
            F.min("avg_age").alias("young"),
            F.max("avg_age").alias("old"),
        )
    ).scalar()
    counts = _position(F.col("count"), edge.few, edge.many)
    return means.select(
        "country",
        "avg_age",
        "count",
        (F.lit(low) + F.lit(high - low) * counts).alias("size"),
        _position(F.col("avg_age"), edge.young, edge.old).alias("heat"),
        band("avg_age").alias("band"),
    )


def panels(results: dict[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    """The frames behind the dashboard's panels, by title, from the five results."""
    inflow = inflow_series(results["user_inflow"], as_of)
    return {
        INFLOW_PANEL: inflow.withColumn("band", band("count")),
        GENDER_PANEL: share(results["gender_distribution"]),
        AGE_PANEL: bracket_bars(results["age_distribution"]),
        COUNTRY_PANEL: top_k(results["country_distribution"]),
        MEAN_PANEL: markers(results["avg_age_by_country"]),
    }


def _position(value: Column, low: Column, high: Column) -> Column:
    """Where a value lies between two bounds, 0 to 1."""
    part = (value - low).cast("double") / (high - low)
    return F.when(value.isNotNull(), F.when(high == low, 0.0).otherwise(part))
