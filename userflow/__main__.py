"""Command line of the jobs, for ``spark-submit`` or ``python -m userflow``.

``analyse`` keeps the result tables of a topic up to date, ``backfill`` makes them once
from what the topic holds. ``ingest`` publishes landed record files to the topic. All
need Spark's Kafka connector package, and take servers and topic from the environment
when they are not given. ``--option name=value`` passes any other connector option.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from userflow.session import build_session
from userflow.sources import topic
from userflow.streaming import pipeline


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="userflow")
    jobs = parser.add_subparsers(dest="job", required=True)
    analyse = jobs.add_parser("analyse", help="topic to result tables")
    backfill = jobs.add_parser("backfill", help="result tables from what the topic holds")
    analyse.add_argument("--mode", default="complete", choices=["complete", "update", "bounded"])
    analyse.add_argument("--every", default=pipeline.EVERY)
    analyse.add_argument("--per-batch", action="store_true", help="age counts per batch")
    analyse.add_argument("--shared-scan", action="store_true")
    analyse.add_argument("--max-per-trigger", type=int)
    analyse.add_argument("--starting", default="latest", help="offsets of a first start")
    analyse.add_argument("--window", default="1 minute")
    analyse.add_argument("--watermark", default="1 minute")
    analyse.add_argument("--state-partitions", type=int, default=pipeline.STATE_PARTITIONS)
    backfill.add_argument("--starting", default="earliest")
    backfill.add_argument("--ending", default="latest")
    backfill.add_argument("--batch-id", type=int, default=0)
    for job, by in ((analyse, "processing"), (backfill, "arrival")):
        job.add_argument("--root", required=True, help="folder of the result tables")
        job.add_argument("--parse", default="normalized", choices=["normalized", "declared"])
        job.add_argument("--skip-bad", action="store_true")
        job.add_argument("--unknown-label", help="bracket of unknown ages")
        job.add_argument("--inflow-by", default=by, choices=pipeline.INFLOW_TIMES)
        job.add_argument("--min-partitions", type=int)
    ingest = jobs.add_parser("ingest", help="record files to topic")
    ingest.add_argument("--records", required=True, help="folder of JSON record files")
    ingest.add_argument("--responses", action="store_true", help="files hold API responses")
    ingest.add_argument("--rejected", help="folder for responses without records")
    ingest.add_argument("--as-is", action="store_true", help="publish records byte by byte, not in the spaced form")
    ingest.add_argument("--every", default="5 seconds")
    ingest.add_argument("--max-files", type=int, default=topic.MAX_FILES, help="of one batch")
    for job in (analyse, backfill, ingest):
        job.add_argument("--servers", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS"))
        job.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC", topic.USER_TOPIC))
        job.add_argument("--packages", help="connector package to load")
        job.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
        if job is not backfill:
            job.add_argument("--checkpoint", required=True)
    args = parser.parse_args(argv)
    if not args.servers:
        parser.error("give --servers or set KAFKA_BOOTSTRAP_SERVERS")
    if args.job == "ingest" and args.responses and not args.rejected:
        parser.error("give --rejected, a folder for responses without records")
    args.extra = dict(pair.partition("=")[::2] for pair in args.option)
    return args


def _parsing(args: argparse.Namespace) -> dict:
    return {
        "parse": args.parse,
        "skip_bad": args.skip_bad,
        "inflow_by": args.inflow_by,
        "unknown_label": args.unknown_label,
    }


def analyse(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    messages = topic.stream_topic(
        spark,
        args.servers,
        topic=args.topic,
        starting=args.starting,
        min_partitions=args.min_partitions,
        max_per_trigger=args.max_per_trigger,
        extra=args.extra,
    )
    parsing = {**_parsing(args), "window": args.window, "watermark": args.watermark}
    if args.per_batch:
        parsing["per_batch"] = True
    return pipeline.run_pipeline(
        messages,
        args.root,
        args.checkpoint,
        args.mode,
        args.every,
        args.shared_scan,
        args.state_partitions,
        **parsing,
    )


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = topic.read_topic(
        spark,
        args.servers,
        topic=args.topic,
        starting=args.starting,
        ending=args.ending,
        min_partitions=args.min_partitions,
        extra=args.extra,
    )
    pipeline.backfill(messages, args.root, args.batch_id, **_parsing(args))


def ingest(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    lines = topic.stream_record_files(spark, args.records, args.max_files)
    queries = []
    if args.responses:
        split = topic.split_responses(lines)
        queries.append(
            topic.keep_rejected(split, args.rejected, f"{args.checkpoint}/rejected", args.every)
        )
        lines = topic.accepted(split)
    messages = topic.encode_records(lines, spaced=not args.as_is)
    sent = topic.publish_stream(
        messages, args.servers, f"{args.checkpoint}/sent" if queries else args.checkpoint,
        args.topic, args.every, args.extra,
    )
    return [*queries, sent]


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"userflow-{args.job}", packages=args.packages)
    try:
        if args.job == "backfill":
            backfill(spark, args)
        else:
            pipeline.wait_for((analyse if args.job == "analyse" else ingest)(spark, args))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
