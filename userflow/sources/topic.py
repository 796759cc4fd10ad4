"""The message topic: reading, encoding and publishing user records.

The broker paths need Spark's Kafka connector package on the cluster. Files that
hold rows in the topic layout work everywhere and take the same decode path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from userflow.functions.json_text import escaped, json_text, respaced
from userflow.schema import TOPIC

# The topic of user records, and the list field of a response.
USER_TOPIC = "user_data"
RESPONSE_LIST = "results"

# Files of a backlog that one micro-batch of an ingestion takes.
MAX_FILES = 1000

# How long after a message its repeat is known as one.
REPEATS = "1 hour"


def topic_options(
    servers: str,
    topic: str = USER_TOPIC,
    starting: str = "latest",
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
    ending: str | None = None,
    since: int | None = None,
    until: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Source options for one topic.

    ``starting`` and ``ending`` are offsets as the connector takes them, ``since`` and
    ``until`` times in epoch milliseconds that stand in their place; the endings hold for
    batch reads. ``extra`` are any other options, such as ``kafka.security.protocol``,
    and override the rest.

    One topic partition is one task by default, so a topic with few or uneven
    partitions bounds the whole job. ``min_partitions`` splits large offset ranges
    over more tasks. ``max_per_trigger`` bounds a micro-batch after an outage.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if since is not None:
        del options["startingOffsets"]
        options["startingTimestamp"] = str(since)
    if until is not None:
        options["endingTimestamp"] = str(until)
    elif ending is not None:
        options["endingOffsets"] = ending
    return {**options, **(extra or {})}


def stream_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """The topic as a stream, from the latest offsets unless told otherwise."""
    settings = topic_options(servers, **options)
    return spark.readStream.format("kafka").options(**settings).load()


def read_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """What the topic holds now, as a batch; a batch starts at the earliest offset."""
    settings = topic_options(servers, **{"starting": "earliest", **options})
    settings.pop("maxOffsetsPerTrigger", None)
    return spark.read.format("kafka").options(**settings).load()


def stream_topic_files(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """A stream of parquet files that hold topic rows."""
    reader = spark.readStream.schema(TOPIC)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


def encode_topic(users: DataFrame, uuid: Column | None = None, spaced: bool = False) -> DataFrame:
    """Key and value of one message per row.

    The value is the whole row as JSON, null fields included. The key is
    ``{"uuid": ...}``, or null for a row without one; by default it is read from
    ``login.uuid`` when the frame has a ``login``. With ``spaced`` both have the bytes that a
    producer in Python writes (``json_text``), so that a user's messages of either producer
    go to one topic partition.
    """
    if uuid is None and "login" in users.columns:
        uuid = F.col("login.uuid")
    if spaced:
        record = json_text(F.struct("*"), users.schema)
    else:
        record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return users.select(_key(uuid, spaced).alias("key"), record.cast("binary").alias("value"))


def encode_records(lines: DataFrame, spaced: bool = False) -> DataFrame:
    """Messages out of JSON text, one record per ``value``, published unchanged, or in the
    ``spaced`` form; what does not parse is published unchanged in either."""
    uuid = F.get_json_object("value", "$.login.uuid")
    value = F.col("value")
    if spaced:
        # Parsed whole, since a broken text must not be taken apart.
        value = F.when(F.try_parse_json("value").isNotNull(), respaced(value)).otherwise(value)
    return lines.select(_key(uuid, spaced).alias("key"), value.cast("binary").alias("value"))


def split_responses(responses: DataFrame) -> DataFrame:
    """One JSON record per row (``value``) out of API responses that list several.

    A response that does not parse or lists nothing under that name gives one row, with
    itself as ``rejected`` and a null ``value``; an empty list gives none. ``accepted`` and
    ``rejected`` take them apart.
    """
    listed = F.from_json("value", f"{RESPONSE_LIST} array<string>")[RESPONSE_LIST]
    either = F.when(
        listed.isNull(),
        F.array(F.struct(F.lit(None).cast("string").alias("value"), F.col("value").alias("rejected"))),
    ).otherwise(
        F.transform(
            listed, lambda r: F.struct(r.alias("value"), F.lit(None).cast("string").alias("rejected"))
        )
    )
    return responses.select(F.explode(either).alias("one")).select("one.value", "one.rejected")


def accepted(split: DataFrame) -> DataFrame:
    """The records of ``split_responses``."""
    return split.where("value is not null").select("value")


def rejected(split: DataFrame) -> DataFrame:
    """The responses that ``split_responses`` found no records in, as they came."""
    return split.where("rejected is not null").select(F.col("rejected").alias("value"))


def without_repeats(messages: DataFrame, within: str = REPEATS, time_col: str = "timestamp") -> DataFrame:
    """Each message once, though it was sent or landed again.

    On a stream the first of several stays, and a message is known for ``within`` after its
    time in ``time_col``: that long a retry may take, and the state holds no more. Of a batch
    one of each stays, whatever the times.

    A message is known by its key, one without a key by its value, and one without either by
    its place in the topic; where it has none of them (an empty message that was landed as a
    file) it cannot be told from a repeat. Messages that share a key though they are not the
    same must not go through here.
    """
    # Two repeats may have gone to other partitions of the topic, so its places do not count.
    place = F.concat_ws(":", "topic", "partition", "offset") if "offset" in messages.columns else F.lit("")
    known = F.coalesce(F.concat(F.lit("k"), F.hex("key")), F.concat(F.lit("v"), F.sha2("value", 256)), place)
    named = messages.withColumn("_message", known)
    if messages.isStreaming:
        once = named.withWatermark(time_col, within).dropDuplicatesWithinWatermark(["_message"])
    else:
        once = named.dropDuplicates(["_message"])
    return once.drop("_message")


def as_topic_rows(
    messages: DataFrame, topic: str = USER_TOPIC, arrived: Column | None = None
) -> DataFrame:
    """Messages in the layout a topic read has, to land them as files. They have no
    broker position, so partition and offset are null."""
    arrived = F.current_timestamp() if arrived is None else arrived
    return messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        arrived.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def publish(
    messages: DataFrame,
    servers: str,
    topic: str = USER_TOPIC,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Send messages to the topic; delivery is at least once. ``extra`` are any other
    options of the connector, such as producer or security settings."""
    _to_broker(messages.write, servers, topic, extra).save()


def publish_stream(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str = USER_TOPIC,
    every: str = "5 seconds",
    extra: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Keep sending: what arrives in the source goes to the topic."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    return _to_broker(writer.trigger(processingTime=every), servers, topic, extra).start()


def stream_record_files(
    spark: SparkSession, path: str, max_files: int | None = MAX_FILES
) -> DataFrame:
    """A stream of text files with one raw JSON record per line; a batch takes up to
    ``max_files`` of a backlog, or with None all."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def land_stream(
    messages: DataFrame, path: str, checkpoint: str, every: str | None = None, repeats: str | None = None
) -> StreamingQuery:
    """Keep landing messages as topic files instead of sending them to a broker.

    Without ``every`` the query handles what is there and ends. With ``repeats``, a time, a
    message that comes again within it is not landed again (``without_repeats``).
    """
    rows = as_topic_rows(messages)
    if repeats is not None:
        rows = without_repeats(rows, repeats)
    return _landing(rows, "parquet", path, checkpoint, every)


def keep_rejected(
    split: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the responses without records as text files. The query's observed metrics
    ``responses`` count them as ``rejected``."""
    counted = rejected(split).observe("responses", F.count(F.lit(1)).alias("rejected"))
    return _landing(counted, "text", path, checkpoint, every)


def _landing(
    rows: DataFrame, kind: str, path: str, checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    return writer.format(kind).option("path", path).start()


def _key(uuid: Column | None, spaced: bool) -> Column:
    if uuid is None:
        return F.lit(None).cast("binary")
    if spaced:
        key = F.concat(F.lit('{"uuid": "'), escaped(uuid.cast("string")), F.lit('"}'))
    else:
        key = F.to_json(F.struct(uuid.alias("uuid")))
    return F.when(uuid.isNotNull(), key).cast("binary")


def _to_broker(writer, servers: str, topic: str, extra: Mapping[str, str] | None):
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **(extra or {})}
    return writer.format("kafka").options(**options)
