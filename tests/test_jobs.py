import pytest

from userflow import __main__ as jobs


def test_arguments_come_from_the_command_line_or_environment(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    monkeypatch.delenv("KAFKA_TOPIC", raising=False)
    where = ["--root", "/r", "--checkpoint", "/c"]
    with pytest.raises(SystemExit):
        jobs.arguments(["analyse", *where])
    args = jobs.arguments(["analyse", *where, "--servers", "h:1", "--shared-scan"])
    assert (args.servers, args.topic, args.mode, args.every) == (
        "h:1", "user_data", "complete", "10 seconds",
    )
    assert args.shared_scan and not args.skip_bad
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "env:1")
    monkeypatch.setenv("KAFKA_TOPIC", "other")
    args = jobs.arguments(["ingest", "--records", "/i", "--checkpoint", "/c"])
    assert (args.servers, args.topic, args.every) == ("env:1", "other", "5 seconds")


class Recorded:
    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = (args, kwargs)
            return self

        return call


@pytest.fixture
def parts(monkeypatch):
    spark, topic, pipeline = Recorded(), Recorded(), Recorded()
    topic.USER_TOPIC, topic.MAX_FILES = "user_data", 1000
    pipeline.EVERY, pipeline.STATE_PARTITIONS = "10 seconds", 8
    pipeline.INFLOW_TIMES = ("processing", "arrival", "record")
    monkeypatch.setattr(jobs, "build_session", lambda *a, **k: spark)
    monkeypatch.setattr(jobs, "topic", topic)
    monkeypatch.setattr(jobs, "pipeline", pipeline)
    return spark, topic, pipeline


def test_analyse_runs_the_pipeline_and_closes(parts):
    spark, topic, pipeline = parts
    jobs.main(["analyse", "--root", "/r", "--checkpoint", "/c", "--servers", "h", "--skip-bad"])
    assert topic.calls["stream_topic"][0] == (spark, "h")
    args, parsing = pipeline.calls["run_pipeline"]
    assert args[1:] == ("/r", "/c", "complete", "10 seconds", False, 8)
    assert parsing == {
        "parse": "normalized", "skip_bad": True, "inflow_by": "processing", "unknown_label": None,
        "window": "1 minute", "watermark": "1 minute",
    }
    assert "wait_for" in pipeline.calls and "stop" in spark.calls


def test_options_reach_the_source_and_the_pipeline(parts):
    spark, topic, pipeline = parts
    jobs.main([
        "analyse", "--root", "/r", "--checkpoint", "/c", "--servers", "h", "--starting", "earliest",
        "--window", "5 minutes", "--watermark", "1 hour", "--state-partitions", "3", "--inflow-by", "arrival",
        "--option", "kafka.security.protocol=SASL_SSL", "--option", "kafka.sasl.jaas.config=a=b;",
    ])
    source = topic.calls["stream_topic"][1]
    assert source["starting"] == "earliest"
    assert source["extra"] == {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.jaas.config": "a=b;"}
    args, parsing = pipeline.calls["run_pipeline"]
    assert args[-1] == 3
    assert (parsing["window"], parsing["watermark"], parsing["inflow_by"]) == ("5 minutes", "1 hour", "arrival")


def test_backfill_reads_a_bounded_topic(parts):
    spark, topic, pipeline = parts
    jobs.main(["backfill", "--root", "/r", "--servers", "h", "--ending", "x", "--batch-id", "4"])
    assert topic.calls["read_topic"][1]["ending"] == "x"
    args, parsing = pipeline.calls["backfill"]
    assert args[1:] == ("/r", 4) and parsing["inflow_by"] == "arrival"
    assert "stop" in spark.calls and "wait_for" not in pipeline.calls


def test_ingest_publishes_the_records(parts):
    spark, topic, pipeline = parts
    with pytest.raises(SystemExit):
        jobs.main(["ingest", "--records", "/i", "--checkpoint", "/c", "--servers", "h", "--responses"])
    where = ["--records", "/i", "--checkpoint", "/c", "--servers", "h", "--max-files", "7"]
    jobs.main(["ingest", *where, "--responses", "--rejected", "/bad"])
    assert topic.calls["stream_record_files"][0][1:] == ("/i", 7)
    assert {"split_responses", "accepted", "encode_records"} <= set(topic.calls)
    assert topic.calls["keep_rejected"][0][1:] == ("/bad", "/c/rejected", "5 seconds")
    assert topic.calls["publish_stream"][0][1:] == ("h", "/c/sent", "user_data", "5 seconds", {})
    assert "stop" in spark.calls
