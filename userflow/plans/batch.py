"""Batch queries over the test tables: parse, aggregate, shape, store."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.times import wall_clock, wall_time
from userflow.operators import analytics, frequent, views
from userflow.operators.parse import parse_users, unknown_value, with_event_time
from userflow.plans.users import (
    arrived_messages,
    damaged_messages,
    flat_columns,
    raw_columns,
    raw_messages,
    raw_records,
    spread_series,
    user_messages,
    user_records,
)
from userflow.session import scratch
from userflow.sources import buckets, levels, skipping, tables, topic
from userflow.streaming import latest, pipeline

NTZ = "timestamp_ntz"


def _users(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Users parsed from their messages, with only the given fields; ``timestamp``
    becomes the event time ``ts``."""
    users = parse_users(user_messages(spark, sf_dir), fields=fields)
    return with_event_time(users, "ts", NTZ) if "timestamp" in fields else users


# -- the five analytics ----------------------------------------------------------


def gender_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.gender_distribution(_users(spark, sf_dir, "gender"))


def age_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.age_distribution(_users(spark, sf_dir, "age"))


def age_distribution_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.age_distribution(
        _users(spark, sf_dir, "age"), unknown_label="unknown"
    )


def age_distribution_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ages_by_day(spark, sf_dir).withColumnRenamed("timestamp", "batch_ts")


def _ages_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir, "age", "timestamp")
    day = F.date_trunc("day", "ts").cast(NTZ)
    return analytics.age_distribution(
        users.withColumn("day", day), per_batch=True, batch_col="day"
    )


def country_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.country_distribution(_users(spark, sf_dir, "country"))


def avg_age_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.avg_age_by_country(_users(spark, sf_dir, "age", "country"))


def user_inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.user_inflow(_users(spark, sf_dir, "timestamp"), "ts")


def inflow_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the time the topic got each message."""
    messages = arrived_messages(user_records(spark, sf_dir), flat_columns())
    inflow = pipeline.topic_results(messages, inflow_by="arrival")["user_inflow"]
    return _windows(inflow.drop("timestamp"))


def inflow_by_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a clock that stands still: one window holds every message, parsed or not."""
    now = wall_time(datetime(2024, 2, 1, 12, 30, 45)).cast("timestamp")
    results = pipeline.topic_results(damaged_messages(spark, sf_dir), as_of=now)
    return _windows(results["user_inflow"])


def _windows(rows: DataFrame) -> DataFrame:
    times = [c for c in rows.columns if c != "count"]
    return rows.select(*(F.col(c).cast(NTZ).alias(c) for c in times), "count")


def analytics_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir, "gender", "age", "country", "timestamp")
    return analytics.analytics_in_one_pass(users, "ts")


# -- dashboard views -------------------------------------------------------------


def user_inflow_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of the stored inflow, seen half a day before its newest window."""
    root = scratch(spark, "inflow")
    tables.replace(user_inflow(spark, sf_dir), root, "user_inflow")
    inflow = tables.find(spark, root, "user_inflow", columns=["window_start", "count"])
    newest = inflow.agg(F.max("window_start")).scalar()
    return views.inflow_series(inflow, newest - F.expr("interval 12 hours"), "1 day")


def _levels(spark: SparkSession, windows: DataFrame, *keys: str) -> tuple[str, list]:
    """Levels of time made of windows, and a few ranges over them."""
    root = scratch(spark, "levels")
    tables.replace(windows, root, "windows")
    stored = tables.table(spark, root, "windows")
    levels.add(stored, root, "inflow", keys)
    first, last = stored.agg(F.min("window_start"), F.max("window_start")).first()
    edges = ((0, 1), (7, -11), (4321, -1560))
    return root, [(first + timedelta(minutes=a), last + timedelta(minutes=b)) for a, b in edges]


def inflow_of_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users came in each of some ranges, from levels of time."""
    root, ranges = _levels(spark, user_inflow(spark, sf_dir))
    totals = (levels.total(spark, root, "inflow", *r).withColumn("range", F.lit(n)) for n, r in enumerate(ranges))
    return reduce(DataFrame.unionByName, totals)


def inflow_of_range_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir, "gender", "timestamp")
    start = F.window("ts", "1 minute").start.alias("window_start")
    root, ranges = _levels(spark, users.groupBy("gender", start).count(), "gender")
    return levels.total(spark, root, "inflow", *ranges[1], keys=["gender"])


def inflow_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours, from the level of hours."""
    root, ranges = _levels(spark, user_inflow(spark, sf_dir))
    first, until = ranges[0]
    hours = levels.series(spark, root, "inflow", 60, first - timedelta(hours=1), until)
    return _in_utc(hours)


def _in_utc(windows: DataFrame) -> DataFrame:
    return windows.select(
        *(wall_clock(F.col(c)).alias(c) if c.startswith("window_") else F.col(c) for c in windows.columns)
    )


def gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.share(gender_distribution(spark, sf_dir))


def latest_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir, "gender", "timestamp")
    daily = users.groupBy("gender", F.date_trunc("day", "ts").alias("timestamp")).count()
    return views.latest(daily, "gender")


def age_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.bracket_bars(_ages_by_day(spark, sf_dir))


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_k(country_distribution(spark, sf_dir))


def top_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent of a hundred thousands of values, without a count for each."""
    return frequent.top_k(_users(spark, sf_dir, "id").select(spread_series()), "series", tracked=1000)


def user_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.total(country_distribution(spark, sf_dir))


def country_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.markers(avg_age_by_country(spark, sf_dir))


def inflow_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_inflow(spark, sf_dir).select(
        "window_start", "count", views.band("count").alias("band")
    )


# -- parsing and encoding --------------------------------------------------------


def parse_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir, "id", "gender", "age", "country", "timestamp")


def parse_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = parse_users(user_messages(spark, sf_dir), mode="declared")
    return users.drop("location")


def parse_declared_raw_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_users(
        raw_messages(spark, sf_dir),
        mode="declared",
        fields=("id", "gender", "name", "dob", "age", "country", "nationality"),
    )


def parse_normalized_raw_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = parse_users(raw_messages(spark, sf_dir))
    return users.select(
        "id",
        "gender",
        "age",
        "country",
        "nationality",
        F.col("location.coordinates.latitude").alias("latitude"),
        F.col("location.coordinates.longitude").alias("longitude"),
    )


def parse_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of both shapes and damaged ones, with keys that no schema names, one of them
    below a known key."""
    number = F.substring("id", 3, 20).cast("bigint")
    device = F.struct(F.struct((number % 5).alias("version"), F.lit("x").alias("os")).alias("device"))
    more = F.concat(F.lit(","), F.substring(F.to_json(device), 2, 99))
    street = F.concat(F.lit('{"street":{"number":'), number.cast("string"), F.lit("},"))
    flat, raw = (F.to_json(F.struct(*c), {"ignoreNullFields": "false"}) for c in (flat_columns(), raw_columns()))
    text = F.when(number % 2 == 0, flat).otherwise(raw)
    placed = F.replace(text, F.lit('"location":{'), F.concat(F.lit('"location":'), street))
    whole = F.concat(F.expr("left(body, length(body) - 1)"), "more")
    bodies = user_records(spark, sf_dir).select(placed.alias("body"), more.alias("more"), number.alias("number"))
    cut = F.when(F.col("number") % 17 == 0, F.expr("left(body, length(body) - 1)")).otherwise(whole)
    users = parse_users(bodies.select(cut.alias("value")), fields=("id", "country"), unknown=True)
    return users.select(
        F.when(F.col("unknown").isNotNull(), F.col("id")).alias("id"),
        F.when(F.col("unknown").isNotNull(), F.col("country")).alias("country"),
        unknown_value("$.device.os").alias("os"),
        unknown_value("$.device.version", "int").alias("version"),
        unknown_value("$.location.street.number", "bigint").alias("street"),
        unknown_value("$.location.country").alias("declared"),
    )


def malformed_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = parse_users(damaged_messages(spark, sf_dir), fields=("gender",))
    return analytics.gender_distribution(users)


def malformed_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = parse_users(
        damaged_messages(spark, sf_dir), fields=("gender",), skip_bad=True
    )
    return analytics.gender_distribution(users)


def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def publish_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def _as_text(messages: DataFrame) -> DataFrame:
    return messages.select(*(F.col(c).cast("string").alias(c) for c in ("key", "value")))


def publish_spaced_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the spaced form, with quotes, nulls in a list, and characters beyond ASCII."""
    number = F.substring("id", 3, 20).cast("bigint")
    users = user_records(spark, sf_dir).select(
        "id",
        "gender",
        "age",
        F.struct("country").alias("location"),
        F.concat(F.lit('Jos\u00e9 "'), "id", F.lit('" \U0001f600\n')).alias("name"),
        F.array("gender", F.lit(None)).alias("tags"),
        (number / 8).alias("share"),
    )
    return _as_text(topic.encode_topic(users, F.col("id"), spaced=True))


def publish_respaced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the published shape, as JSON text without spaces, in the spaced form."""
    records = raw_records(user_records(spark, sf_dir))
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return _as_text(topic.encode_records(records.select(whole.alias("value")), spaced=True))


def split_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that list a user's record in both shapes, split and parsed, and those
    without a list, as they are."""
    shapes = (F.to_json(F.struct(*flat_columns())), F.to_json(F.struct(*raw_columns())))
    body = F.concat(
        F.lit('{"results":['), F.concat_ws(",", *shapes), F.lit('],"info":{}}')
    )
    number = F.substring("id", 3, 20).cast("bigint")
    error = F.concat(F.lit('{"error":"'), "id", F.lit('"}'))
    bad = F.when(number % 11 == 0, error).when(number % 37 == 0, F.concat("id", F.lit(" oops")))
    responses = user_records(spark, sf_dir).select(F.coalesce(bad, body).alias("value"))
    split = topic.split_responses(responses)
    messages = topic.encode_records(topic.accepted(split))
    users = parse_users(messages, fields=("id", "gender", "age", "country"))
    lost = topic.rejected(split).withColumnRenamed("value", "rejected")
    return users.unionByName(lost, allowMissingColumns=True)


# -- tables ----------------------------------------------------------------------


def find_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    old_unknown = F.col("gender").isNull() & (F.col("age") >= 65)
    return tables.find_rows(
        user_records(spark, sf_dir), old_unknown, ["id", "gender", "country"]
    )


def find_users_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.find_rows(
        user_records(spark, sf_dir), {"gender": "male", "country": None}
    )


def find_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given table, found by name under its root."""
    return tables.find(
        spark, sf_dir, "events.parquet", {"event_type": "error"}, ["event_id", "user_id"]
    )


def find_by_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by a range and by a list of ids, each from the files that notes do not rule out."""
    root = scratch(spark, "notes")
    tables.replace(skipping.clustered(user_records(spark, sf_dir), ["age", "id"], 16), root, "users")
    skipping.index(spark, root, "users", ["age", "country"], ["id"])
    wanted = {"age": skipping.Between(30, 33), "country": ["FRANCE", "CHINA", None]}, {"id": ["u-5", "u-77", "u-none"]}
    found = (skipping.find(spark, root, "users", where) for where in wanted)
    return reduce(DataFrame.unionByName, found)


def append_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, users = scratch(spark, "append"), user_records(spark, sf_dir)
    tables.append(users.where("gender is null"), root, "users", with_id=True)
    tables.append(users.where("gender is not null"), root, "users", with_id=True)
    return tables.find(spark, root, "users").drop("_id")


def replace_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "replace")
    known = _users(spark, sf_dir, "gender", "age").where("age is not null")
    everyone = _users(spark, sf_dir, "gender")
    for batch_id, users in enumerate((known, everyone, everyone.where("false"))):
        result = analytics.gender_distribution(users)
        tables.replace(tables.with_lineage(result, batch_id), root, "gender_distribution")
    return tables.table(spark, root, "gender_distribution").drop("updated_at")


def _update_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Users with a known country, and changes to the old or countryless ones."""
    users = user_records(spark, sf_dir)
    changes = users.where("age >= 65 or country is null").select(
        "id",
        F.lit(None).cast("string").alias("gender"),
        (F.col("age") + 1).alias("age"),
        "country",
        "ts",
    )
    return users.where("country is not null"), changes


def upsert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "upsert")
    target, changes = _update_parts(spark, sf_dir)
    tables.replace(target, root, "users")
    tables.replace(changes, root, "changes")
    tables.upsert(tables.table(spark, root, "changes"), root, "users", ["id"], insert=True)
    return tables.table(spark, root, "users")


def upsert_bucketed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in hash buckets of the id: only touched buckets are read and written."""
    root = scratch(spark, "buckets")
    target, changes = _update_parts(spark, sf_dir)
    tables.replace(changes, root, "changes")
    buckets.create(target, root, "users", ["id"], 16)
    buckets.upsert(tables.table(spark, root, "changes"), root, "users")
    return buckets.read(spark, root, "users")


def latest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest record of each country's users."""
    users = _users(spark, sf_dir, "id", "gender", "age", "country", "timestamp")
    return latest.latest_users(users.withColumn("ts", F.col("ts").cast("timestamp")), "country", "ts").withColumn("ts", F.col("ts").cast(NTZ))


def append_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single documents beside a table's rows; what a document lacks is null."""
    root, users = scratch(spark, "append"), user_records(spark, sf_dir)
    tables.append(users.select("id", "gender", "age"), root, "users", with_id=True)
    schema = "id string, gender string, age int"
    for row in ({"id": "one", "age": 30}, {"id": "two", "gender": "x"}):
        tables.append_row(spark, root, "users", row, schema)
    return tables.find(spark, root, "users", columns=["id", "gender", "age"])


def update_where_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set in place where a condition holds, and added where none does; the first of the
    conditions is for a table that is not there yet."""
    root, users = scratch(spark, "update"), user_records(spark, sf_dir)
    kinds = users.schema
    tables.update_where(spark, root, "users", {"id": "new"}, {"age": 1}, True, kinds)
    tables.append(users, root, "users")
    tables.update_where(spark, root, "users", "age >= 65", {"age": F.col("age") + 1, "gender": None})
    tables.update_where(spark, root, "users", {"id": "other", "country": None}, {"age": 2}, True)
    return tables.table(spark, root, "users")


def update_first_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match set, the first by its id."""
    root = scratch(spark, "first")
    tables.append(user_records(spark, sf_dir), root, "users")
    tables.update_where(spark, root, "users", {"gender": "female"}, {"country": "unknown"}, first_by=["id"])
    return tables.table(spark, root, "users")


def update_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = _update_parts(spark, sf_dir)
    merged = tables.merge_rows(target, changes.select("id", "gender", "age"), ["id"])
    return merged.drop("_merge")


def set_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns set where a condition holds, without a join."""
    changed = tables.update_rows(
        user_records(spark, sf_dir),
        {"country": None, "gender": "female"},
        {"country": "unknown", "age": F.col("age") + 1},
    )
    return changed.withColumnRenamed("_merge", "outcome")


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, changes = _update_parts(spark, sf_dir)
    merged = tables.merge_rows(target, changes, ["id"], insert=True)
    return merged.groupBy(F.col("_merge").alias("outcome")).count()


def documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = user_records(spark, sf_dir)
    return tables.to_documents(users.select("id", F.col("ts").alias("timestamp")))


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = wall_time(datetime(2024, 2, 1, 12, 30, 45))
    return tables.to_json_documents(
        tables.with_lineage(_ages_by_day(spark, sf_dir), 7, written)
    )


QUERIES = {
    query.__name__: query
    for query in (
        gender_distribution,
        age_distribution,
        age_distribution_known,
        age_distribution_by_batch,
        country_distribution,
        avg_age_by_country,
        user_inflow,
        inflow_by_arrival,
        inflow_by_processing_time,
        analytics_in_one_pass,
        user_inflow_recent,
        inflow_of_ranges,
        inflow_of_range_by_gender,
        inflow_by_hour,
        gender_share,
        latest_by_gender,
        age_bars,
        top_countries,
        top_frequent,
        user_total,
        country_markers,
        inflow_bands,
        parse_normalized,
        parse_declared,
        parse_declared_raw_shape,
        parse_normalized_raw_shape,
        parse_unknown_keys,
        malformed_counted,
        malformed_skipped,
        publish_messages,
        publish_raw_messages,
        publish_spaced_messages,
        publish_respaced_records,
        split_responses,
        find_users,
        find_users_equal,
        find_events,
        find_by_notes,
        append_users,
        replace_result,
        upsert_users,
        upsert_bucketed_users,
        latest_users,
        append_one_user,
        update_where_users,
        update_first_users,
        update_users,
        set_users,
        upsert_counts,
        documents_view,
        json_documents,
    )
}
