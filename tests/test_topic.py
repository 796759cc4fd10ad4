import json

from pyspark.sql import functions as F

from userflow.operators.parse import parse_users
from userflow.plans.users import flat_records, raw_records, user_records
from userflow.schema import TOPIC
from userflow.sources import topic


def test_source_options():
    assert topic.topic_options("h:9092") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "user_data",
        "startingOffsets": "latest",
    }
    options = topic.topic_options("h", "t", "earliest", min_partitions=64, max_per_trigger=10)
    assert options["subscribe"] == "t"
    assert options["startingOffsets"] == "earliest"
    assert options["minPartitions"] == "64"
    assert options["maxOffsetsPerTrigger"] == "10"


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_broker_reader_and_writer_options():
    class Session:
        read, readStream = Recorder(), Recorder()

    topic.read_topic(Session, "h", max_per_trigger=5)
    settings = dict(Session.read.calls[1][2])
    assert settings["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in settings
    topic.stream_topic(Session, "h", max_per_trigger=5)
    assert Session.readStream.calls[0] == ("format", ("kafka",), {})
    assert dict(Session.readStream.calls[1][2])["maxOffsetsPerTrigger"] == "5"

    class Messages:
        write, writeStream = Recorder(), Recorder()

    topic.publish(Messages, "h", "t")
    assert Messages.write.calls == [
        ("format", ("kafka",), {}),
        ("options", (), {"kafka.bootstrap.servers": "h", "topic": "t"}),
        ("save", (), {}),
    ]
    topic.publish_stream(Messages, "h", "/checkpoint", extra={"kafka.acks": "all"})
    calls = Messages.writeStream.calls
    assert ("option", ("checkpointLocation", "/checkpoint"), {}) in calls
    assert ("options", (), {"kafka.bootstrap.servers": "h", "topic": "user_data", "kafka.acks": "all"}) in calls
    assert calls[-1] == ("start", (), {})


def test_keys_hold_the_uuid_or_are_null(spark):
    rows = spark.createDataFrame(
        [("a", ("u1",)), ("b", (None,)), ("c", None)], "gender string, login struct<uuid:string>"
    )
    messages = topic.encode_topic(rows).select(
        F.col("key").cast("string"), F.col("value").cast("string")
    )
    got = [(r.key, json.loads(r.value)) for r in messages.collect()]
    assert got == [
        ('{"uuid":"u1"}', {"gender": "a", "login": {"uuid": "u1"}}),
        (None, {"gender": "b", "login": {"uuid": None}}),
        (None, {"gender": "c", "login": None}),
    ]
    assert [r.key for r in topic.encode_topic(rows.drop("login")).collect()] == [None] * 3


def test_records_are_published_unchanged(spark):
    lines = ['{"login": {"uuid": "u1"},  "gender":"é"}', "{}", "broken"]
    messages = topic.encode_records(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = messages.collect()
    assert [bytes(r.value).decode() for r in rows] == lines
    assert [r.key and bytes(r.key).decode() for r in rows] == ['{"uuid":"u1"}', None, None]


BODIES = [
    '{"results":[{"gender":"m"},{"gender":"f"}],"info":{}}', '{"results":[]}', "oops",
    '{"error":"x"}', '{"results":null}', '{"results":5}', "", '{"results":[null,{"gender":"x"}]}',
]


def test_responses_are_split_into_records(spark):
    split = topic.split_responses(spark.createDataFrame([(b,) for b in [*BODIES, None]], "value string"))
    assert [json.loads(r.value)["gender"] for r in topic.accepted(split).collect()] == ["m", "f", "x"]
    assert [r.value for r in topic.rejected(split).collect()] == [BODIES[i] for i in (2, 3, 4, 5, 6)]


def test_rejected_responses_are_counted_and_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, body in enumerate(BODIES):
        (tmp_path / "in" / f"{i}.json").write_text(body + "\n" if body else "")
    lines = topic.stream_record_files(spark, str(tmp_path / "in"), max_files=3)
    query = topic.keep_rejected(topic.split_responses(lines), str(tmp_path / "bad"), str(tmp_path / "c"))
    query.awaitTermination()
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "bad")).collect()) == sorted(BODIES[i] for i in (2, 3, 4, 5))
    batches = [p for p in query.recentProgress if "responses" in p.observedMetrics]
    assert sum(p.observedMetrics["responses"].rejected for p in batches) == 4 and len(batches) >= 3


def test_connector_options_pass_through():
    secured = topic.topic_options("h", extra={"kafka.security.protocol": "SSL", "startingOffsets": "x"})
    assert secured["kafka.security.protocol"] == "SSL" and secured["startingOffsets"] == "x"
    timed = topic.topic_options("h", since=5, until=9, ending="latest")
    assert timed["startingTimestamp"] == "5" and timed["endingTimestamp"] == "9"
    assert not {"startingOffsets", "endingOffsets"} & set(timed)
    assert topic.topic_options("h", ending="latest")["endingOffsets"] == "latest"


def test_topic_rows_have_the_topic_layout(spark, small_dir):
    messages = topic.encode_topic(user_records(spark, small_dir))
    rows = topic.as_topic_rows(messages)
    expected = spark.createDataFrame([], TOPIC)
    assert dict(rows.dtypes) == dict(expected.dtypes)
    assert rows.columns == expected.columns


def test_round_trip_loses_nothing(spark, small_dir):
    users = user_records(spark, small_dir)
    want = users.select("id", "gender", "age", "country")
    flat = parse_users(topic.encode_topic(flat_records(users)), "declared", want.columns)
    raw = parse_users(topic.encode_topic(raw_records(users)), fields=want.columns)
    for got in (flat, raw):
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
