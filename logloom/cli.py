"""Command line: create, load, check, aggregate and evaluate a log's tables; produce and consume a topic; measure the stream.

Options that aren't given come from the environment (settings.Settings).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from logloom.operators import constraints, evaluate, load
from logloom.operators.features import build_matrix
from logloom.settings import Settings
from logloom.sources import schemas, topic
from logloom.sources.log_text import read_lines
from logloom.streaming import exact, measure, replay, scoring, sink

#: Commands that work on the tables of a warehouse.
ON_TABLES = ("init", "load", "run", "check", "aggregate", "evaluate", "export-stats")


def _parser(settings: Settings) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="logloom")
    parser.add_argument("--warehouse", default=settings.warehouse, help="folder of the tables")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("check", help="count violations of the tables' rules; fails where there are any")
    commands.add_parser("init", help="create the tables")
    for name in ("load", "run"):
        c = commands.add_parser(name)
        c.add_argument("log")
        c.add_argument("--limit", type=int)
    for name in ("init", "run"):
        commands.choices[name].add_argument("--reset", action="store_true", help="drop existing tables first")
    for name in ("aggregate", "evaluate", "run", "export-stats"):
        c = commands.choices.get(name) or commands.add_parser(name)
        c.add_argument("--window-seconds", type=int, default=settings.window_seconds)
        if name == "aggregate":
            c.add_argument("--full", action="store_true", help="rebuild all days, not only those that new loads touched")
        else:
            c.add_argument("--train-fraction", type=float, default=settings.train_fraction)
            c.add_argument("--top-templates", type=int, default=settings.top_templates)
    c = commands.add_parser("produce")
    c.add_argument("log")
    c.add_argument("topic")
    c.add_argument("--limit", type=int, help="only the first lines")
    c.add_argument("--speed", type=float, default=0.0, help="times event time; 0: at once")
    c.add_argument("--partitions", type=int, help="of a partitioned topic; a plain folder unless given")
    c.add_argument("--kafka", action="store_true", help="into Kafka; the topic is its name")
    c.add_argument("--window-seconds", type=int, default=settings.window_seconds)
    c = commands.add_parser("consume")
    c.add_argument("topic", nargs="?", default=settings.kafka_topic)
    c.add_argument("out", nargs="?", default=settings.index)
    c.add_argument("--stats", default=settings.statistics)
    c.add_argument("--window-seconds", type=int, default=settings.window_seconds)
    c.add_argument("--lateness", type=int, default=settings.lateness)
    c.add_argument("--max-runtime", type=float, default=settings.max_runtime or None, help="seconds after which the run stops in good order")
    c.add_argument("--kafka", action="store_true", help="from Kafka; the topic is its name")
    c.add_argument("--partitioned", action="store_true", help="the topic is a partitioned one")
    c.add_argument("--per-trigger", type=int, help="records of a batch at most")
    c.add_argument("--idle-timeout", type=float, default=settings.idle_timeout or None, help="seconds without records after which open windows close and the run ends")
    c = commands.add_parser("measure")
    c.add_argument("log")
    c.add_argument("--limit", type=int)
    c.add_argument("--window-seconds", type=int, default=settings.window_seconds)
    c.add_argument("--partitions", type=int, default=settings.partitions)
    c.add_argument("--runs", type=int, default=1)
    c.add_argument("--members", type=int, nargs="+", help="queries that share the topic; medians over the runs of each number")
    c.add_argument("--speed", type=float, help="measure delays of a replay at so many times event time, not throughput")
    return parser


def _tables(spark, args):
    size = F.col("window_seconds") == args.window_seconds
    return tuple(load.table(spark, args.warehouse, t).filter(size).drop("day") for t in ("window_features", "window_template_counts"))


def _evaluate(spark, args) -> None:
    windows, counts = _tables(spark, args)
    if windows.count() < evaluate.LEAST_WINDOWS:
        print("too few windows to evaluate")
        return
    matrix = build_matrix(windows, counts, args.train_fraction, args.top_templates)
    predictions = evaluate.evaluate(matrix).cache()
    scored = evaluate.scores(predictions).cache()
    try:
        load.store_evaluation(predictions, scored, args.warehouse, args.window_seconds)
        print(evaluate.report(scored, evaluate.split_description(matrix), args.window_seconds))
    finally:
        scored.unpersist()
        predictions.unpersist()


def _produce(spark, args, settings: Settings) -> None:
    lines = read_lines(spark, args.log, args.limit)
    if args.kafka:
        if args.speed:
            raise ValueError("a paced replay into Kafka is not supported")
        replay.produce_kafka(lines, settings.servers(), args.topic, args.window_seconds)
    elif args.partitions and args.speed:
        print(json.dumps({"slices": replay.paced_partitioned(lines, args.topic, args.speed, args.partitions, args.window_seconds)}))
    elif args.partitions:
        print(json.dumps(replay.produce_partitioned(lines, args.topic, args.partitions, args.window_seconds)))
    else:
        print(json.dumps({"slices": replay.paced(lines, args.topic, args.speed, args.window_seconds)}))


def _consume(spark, args, settings: Settings) -> None:
    if not args.out:
        raise ValueError("consume needs a folder to write into")
    if args.kafka:
        stream = replay.kafka_stream(spark, settings.servers(), args.topic, args.per_trigger or 5000, settings.kafka_group)
    elif args.partitioned:
        stream = topic.topic_stream(spark, args.topic, args.per_trigger, f"{args.out}/progress")
    else:
        stream = replay.topic_stream(spark, args.topic)
    stats = scoring.load_statistics("".join(r[0] for r in spark.read.text(args.stats, wholetext=True).collect())) if args.stats else None
    columns = schemas.DOCUMENT_TYPES if stats else ()

    def prepare(batch):
        windows = exact.closed_windows(batch, args.window_seconds)
        return scoring.documents(scoring.score_windows(windows, stats)) if stats else windows

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    # Windows close half an idle time after their partition's last record, so that the run sees them closed.
    idle_ms = int(args.idle_timeout * 500) if args.idle_timeout else None
    rows = exact.exact_stream(replay.parsed_events(stream), args.window_seconds, args.lateness, settings.partitions, idle_ms)
    if args.idle_timeout or args.partitioned or args.kafka:
        query = sink.run_until_idle(rows, args.out, prepare=prepare, columns=columns, idle_seconds=args.idle_timeout or 0, max_runtime=args.max_runtime)
    else:
        query = sink.run_available(rows, args.out, prepare=prepare, columns=columns, max_runtime=args.max_runtime)
    print(json.dumps(sink.progress(query)))


def _measure(spark, args) -> None:
    shape = (args.window_seconds, args.partitions)
    for members in args.members or ():
        print(json.dumps(measure.members_runs(spark, read_lines(spark, args.log, args.limit), members, args.runs, *shape)))
    for _ in range(0 if args.members else args.runs):
        lines = read_lines(spark, args.log, args.limit)
        print(json.dumps(measure.throughput_run(spark, lines, *shape) if args.speed is None else measure.delay_run(spark, lines, args.speed, *shape)))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    settings = Settings.from_env()
    args = _parser(settings).parse_args(argv)
    if args.command in ON_TABLES:
        args.warehouse = replace(settings, warehouse=args.warehouse).tables()
    spark = spark or SparkSession.builder.appName("logloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command in ("init", "run"):
        names = load.init(spark, args.warehouse, args.reset)
        if args.command == "init":
            print(json.dumps({"tables": names}))
    if args.command in ("load", "run"):
        print(json.dumps(load.load(spark, read_lines(spark, args.log, args.limit), args.warehouse)))
    if args.command in ("aggregate", "run"):
        print(json.dumps(dict(zip(("windows", "template_rows"), load.refresh_windows(spark, args.warehouse, args.window_seconds, getattr(args, "full", False)), strict=True))))
    if args.command in ("evaluate", "run"):
        _evaluate(spark, args)
    if args.command == "check":
        broken = constraints.of_warehouse(spark, args.warehouse).filter("violations > 0").orderBy("table", "rule").collect()
        print(json.dumps([r.asDict() for r in broken]))
        return 1 if broken else 0
    if args.command == "export-stats":
        print(scoring.export_statistics(*_tables(spark, args), args.window_seconds, args.train_fraction))
    if args.command == "produce":
        _produce(spark, args, settings)
    if args.command == "consume":
        _consume(spark, args, settings)
    if args.command == "measure":
        _measure(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
