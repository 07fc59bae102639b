"""Jobs for spark-submit: ``python -m eventlake <job> --lake <folder>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial

from pyspark.sql import SparkSession

from eventlake.operators.bronze import to_bronze
from eventlake.plans import reports
from eventlake.sources import kafka
from eventlake.sources.tables import DEFAULT_FORMAT
from eventlake.streaming import jobs
from eventlake.streaming.sinks import AVAILABLE_NOW
from eventlake.streaming.supervise import await_all, await_any


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    top.add_argument("job", choices=("publish", "bronze", "silver", "gold", "daily", "report"))
    top.add_argument("--lake", required=True, help="folder of the tables and checkpoints")
    top.add_argument("--format", default=DEFAULT_FORMAT, help="table format, such as delta")
    top.add_argument("--flat", action="store_true", help="no folder per day in bronze and silver tables")
    top.add_argument("--silver-by-type", action="store_true", help="a silver query and table for each event type")
    top.add_argument("--files-per-batch", type=int, default=4, help="files of a micro-batch in each folder, at most")
    top.add_argument("--trigger", default="10 seconds", help=f"interval, or '{AVAILABLE_NOW}'")
    top.add_argument("--servers", help="Kafka servers to read from")
    top.add_argument("--topics", default=kafka.DEFAULT_TOPICS)
    top.add_argument("--starting-offsets", default="latest")
    top.add_argument("--fail-on-data-loss", action="store_true")
    top.add_argument("--publish-servers", help="Kafka servers to publish to")
    top.add_argument("--publish-topic")
    top.add_argument("--first", help="first day of the daily job; by default yesterday")
    top.add_argument("--last", help="last day of the daily job")
    top.add_argument("--append", action="store_true", help="add daily rows to those of the same days")
    top.add_argument("--tables", nargs="*", help="tables to report on, or gold tables to run")
    return top


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    lake = jobs.Lake(args.lake, args.format, not args.flat, args.files_per_batch, not args.silver_by_type)
    if args.job == "daily":
        rows = jobs.run_daily(spark, lake, args.first, args.last, overwrite=not args.append)
        print(f"{rows} daily rows written")
        return
    if args.job == "report":
        reports.show(reports.report_on(partial(lake.read, spark), args.tables))
        return
    if args.job in ("publish", "bronze"):
        if not args.servers:
            raise SystemExit(f"{args.job} needs --servers")
        options = kafka.kafka_source_options(
            args.servers,
            args.topics,
            starting_offsets=args.starting_offsets,
            fail_on_data_loss=args.fail_on_data_loss,
        )
        source = kafka.read_kafka(spark, options)
        if args.job == "bronze":
            queries = [jobs.run_bronze(source, lake, args.trigger)]
        else:
            target = args.publish_servers, args.publish_topic
            queries = [jobs.run_publish(to_bronze(source), lake, args.trigger, *target)]
    elif args.job == "silver":
        target = None
        if args.publish_servers:
            target = jobs.KafkaTarget(args.publish_servers, args.publish_topic)
        queries = jobs.run_silver(spark, lake, args.trigger, kafka=target)
    else:
        queries = jobs.run_gold(spark, lake, args.trigger, only=args.tables)
    # Runs over what is there end one by one; a running job ends with its first query.
    (await_all if args.trigger == AVAILABLE_NOW else await_any)(queries)


if __name__ == "__main__":
    run(SparkSession.builder.appName("eventlake").getOrCreate())
