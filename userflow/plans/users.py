"""User records and topic messages derived from the test tables.

The tables hold no user records, so every event stands for one user whose country
is that of the customer behind it. Nulls are planted on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.times import MICROS, wall_time
from userflow.sources.topic import as_topic_rows, encode_topic


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, gender, age, country, ts``.

    Whether the joins broadcast is left to Spark's check of the table sizes, which
    it knows best when each table joins the events directly. A dimension beyond the
    limit is shuffled, and the adaptive plan splits a user that many events share.
    """
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = events.join(customers, F.col("user_id") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    number = F.col("event_id")
    return placed.select(
        F.concat(F.lit("u-"), number.cast("string")).alias("id"),
        F.when(number % 29 == 0, None)
        .when(F.col("user_id") % 2 == 0, "female")
        .otherwise("male")
        .alias("gender"),
        F.when(number % 23 != 0, (number % 91).cast("int")).alias("age"),
        F.when(number % 31 != 0, F.col("n_name")).alias("country"),
        "ts",
    )


def flat_columns() -> list[Column]:
    """A user in the declared record shape."""
    return [
        F.col("id"),
        F.col("gender"),
        F.col("age"),
        F.struct("country").alias("location"),
        F.date_format("ts", MICROS).alias("timestamp"),
    ]


def raw_columns() -> list[Column]:
    """A user in the published shape: nested name, birth, login and coordinates."""
    number = F.substring("id", 3, 20).cast("bigint")
    return [
        F.col("gender"),
        F.struct(F.col("id").alias("first"), F.lit("User").alias("last")).alias("name"),
        F.struct(
            F.col("country").alias("country"),
            F.struct(
                F.concat((number % 90).cast("string"), F.lit(".25")).alias("latitude"),
                F.concat((-(number % 180)).cast("string"), F.lit(".5")).alias("longitude"),
            ).alias("coordinates"),
        ).alias("location"),
        F.struct(F.col("id").alias("uuid")).alias("login"),
        F.struct(F.date_format("ts", MICROS).alias("date"), "age").alias("dob"),
        F.when(number % 7 != 0, "NA").alias("nat"),
    ]


def spread_series(number: Column | None = None) -> Column:
    """A series of very many values, of which a few are frequent: each power of two half as
    often as the one before, and every other user alone."""
    number = F.substring("id", 3, 20).cast("bigint") if number is None else number
    lowest = number.bitwiseAND(-number)
    return F.concat(F.lit("s-"), F.when(number % 2 == 0, lowest).otherwise(number).cast("string")).alias("series")


def flat_records(users: DataFrame) -> DataFrame:
    return users.select(*flat_columns())


def raw_records(users: DataFrame) -> DataFrame:
    return users.select(*raw_columns())


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user as one message in the declared shape."""
    return encode_topic(flat_records(user_records(spark, sf_dir)), F.col("id"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user as one message in the published shape."""
    return encode_topic(raw_records(user_records(spark, sf_dir)))


def arrived_messages(users: DataFrame, columns: list[Column]) -> DataFrame:
    """Users as topic rows that arrived at their ``ts``."""
    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")
    keyless = users.select(F.lit(None).cast("binary").alias("key"), whole.alias("value"), "ts")
    return as_topic_rows(keyless, arrived=F.col("ts").cast("timestamp"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut short, no JSON, or empty, or hold more than a
    record: other text, or a second one with or without a comma."""
    number = F.substring(F.get_json_object(F.col("key").cast("string"), "$.uuid"), 3, 20)
    number = number.cast("bigint")
    text = F.col("value").cast("string")
    return user_messages(spark, sf_dir).withColumn(
        "value",
        F.when(number % 17 == 0, F.expr("left(cast(value as string), length(value) - 1)"))
        .when(number % 19 == 0, "not json")
        .when(number % 37 == 0, None)
        .when(number % 41 == 0, F.concat(text, F.lit(" junk")))
        .when(number % 43 == 0, F.concat(text, text))
        .when(number % 47 == 0, F.concat(text, F.lit(","), text))
        .when(number % 53 == 0, F.concat(text, F.lit("] junk")))
        .otherwise(text)
        .cast("binary"),
    )


def middle_of_time(spark: SparkSession, sf_dir: str) -> Column:
    edge = load(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    return wall_time(edge[0] + (edge[1] - edge[0]) / 2)


def land_in_two(spark: SparkSession, sf_dir: str, path: str, rows=None, late: Column | None = None):
    """Land all messages as topic files, the earlier half of the time range first.

    A generator: each step lands one half, so that a stream can run in between. ``rows``
    makes topic rows of users; the default ones arrive now. ``late`` users of the earlier
    half land with the other.
    """
    users = user_records(spark, sf_dir)
    early = F.col("ts") < middle_of_time(spark, sf_dir)
    early = early if late is None else early & ~late
    for half in (early, F.coalesce(~early, F.lit(True))):
        if rows is None:
            landed = as_topic_rows(encode_topic(flat_records(users.where(half)), F.col("id")))
        else:
            landed = rows(users.where(half))
        landed.write.mode("append").parquet(path)
        yield path
