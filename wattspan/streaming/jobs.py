"""Command line of the standing jobs.

    spark-submit ... wattspan/streaming/jobs.py processor --servers host:port \\
        --topic readings --checkpoints /shared/checkpoints --output processed

The Kafka and search-index connectors are Spark packages that the cluster
supplies; with ``--files`` topics are folders of message files instead.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattspan.config import DEFAULT_CONFIG, EngineConfig
from wattspan.session import build_session
from wattspan.sinks.messages import SinkSpec
from wattspan.sinks.upsert import UpsertSpec, index_spec
from wattspan.sources.messages import SourceSpec
from wattspan.streaming.control import await_all
from wattspan.streaming.pipelines import Jobs, beside

JOBS = ("processor", "indexer", "lake", "alerts", "spikes")


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="wattspan", description=__doc__.splitlines()[0])
    cli.add_argument("job", choices=JOBS)
    cli.add_argument("--topic", required=True, help="topic, or message folder with --files")
    cli.add_argument("--output", required=True, help="topic, index, or folder to write")
    cli.add_argument("--checkpoints", required=True, help="shared folder for checkpoints")
    cli.add_argument("--servers", help="Kafka bootstrap servers")
    cli.add_argument("--files", action="store_true", help="messages are Parquet files")
    cli.add_argument("--windows", help="processor: folder for the aggregates, else the console")
    cli.add_argument(
        "--mode",
        default="append",
        help="processor: output mode of the aggregates, or rollup for one query that loses no late row",
    )
    cli.add_argument("--key", default="region", help="processor: column that keys the messages")
    cli.add_argument("--rejects", help="indexer: where rejected messages go; lake: a folder for them")
    cli.add_argument("--max-per-trigger", type=int, help="rate cap in offsets or files")
    cli.add_argument("--min-partitions", type=int, help="read splits per trigger")
    cli.add_argument("--interval", help="trigger interval; without it, run to the end once")
    cli.add_argument("--config", help="YAML file with limits and coefficients")
    return cli


def start(spark: SparkSession, arguments: Sequence[str]) -> list[StreamingQuery]:
    """Start the queries of one job."""
    args = parser().parse_args(arguments)
    kind = "parquet" if args.files else "kafka"
    source = SourceSpec(
        args.topic,
        kind=kind,
        servers=args.servers,
        # The lake keeps everything; the other jobs join at the present.
        start="earliest" if args.job == "lake" else "latest",
        max_per_trigger=args.max_per_trigger,
        min_partitions=args.min_partitions,
    )
    cfg = EngineConfig.from_yaml(args.config) if args.config else DEFAULT_CONFIG
    jobs = Jobs(spark, source, args.checkpoints, args.interval, cfg)
    if args.job == "processor":
        sink = SinkSpec(args.output, kind=kind, servers=args.servers, key=args.key)
        republished = jobs.republish(sink)
        if args.mode == "rollup":
            if not args.windows:
                raise SystemExit("--mode rollup needs --windows")
            return [republished, jobs.rollup(args.windows)]
        return [republished, *jobs.windows(args.windows, args.mode)]
    if args.job == "indexer":
        spec = UpsertSpec(args.output) if args.files else index_spec(args.output)
        near = args.output if args.files else f"{args.checkpoints.rstrip('/')}/indexer"
        return [jobs.index_all(spec, args.rejects or beside(near))]
    if args.job == "lake":
        return jobs.lake(args.output, args.rejects)
    if args.job == "spikes":
        return [jobs.spikes(args.output)]
    return [jobs.alerts(args.output)]


def main(arguments: Sequence[str] | None = None) -> None:
    spark = build_session()
    await_all(spark, start(spark, arguments))


if __name__ == "__main__":
    main()
