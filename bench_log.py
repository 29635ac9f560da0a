"""Rates over a log of $BENCH_LINES lines (five million unless given), for comparison by size; prints one JSON line.

The events of $BENCH_SF_DIR are repeated, each copy a whole number of days later, and written
as text before anything is timed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from logloom.operators import aggregate, load
from logloom.operators.parse import good, parse
from logloom.sources.log_text import events_as_lines, read_lines
from logloom.sources.tables import read_table
from logloom.streaming import sink


def written_log(spark: SparkSession, sf_dir: str, lines: int, folder: str) -> int:
    """Text files of at least `lines` lines of the events, repeated; how many there are."""
    events = read_table(spark, sf_dir, "events")
    facts = events.agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"), F.date_diff(F.max("ts"), F.min("ts")).alias("days")).first()
    copies = -(-lines // facts["n"])
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    shifted = events.select("*", copy).withColumns(
        {
            "event_id": F.col("event_id") + F.col("copy") * F.lit(facts["last"] + 1).cast("long"),
            "ts": F.timestamp_seconds(F.unix_timestamp(F.col("ts").cast("timestamp")) + F.col("copy") * F.lit((facts["days"] + 1) * 86400)),
        }
    )
    events_as_lines(shifted).select("value").write.option("lineSep", "\n").text(folder)
    return copies * facts["n"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    folder, took = sink.shared_folder(spark), {}
    lines = written_log(spark, sf_dir, int(os.environ.get("BENCH_LINES", "5000000")), f"{folder}/log")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    parsed = lambda: good(parse(read_lines(spark, f"{folder}/log")))
    steps = {
        "parse": lambda: noop(parsed()),
        "parse_windows_60": lambda: noop(aggregate.window_features(parsed(), 60)),
        "load": lambda: load.load(spark, read_lines(spark, f"{folder}/log"), f"{folder}/tables"),
        "refresh_60": lambda: load.refresh_windows(spark, f"{folder}/tables", 60),
        "load_again": lambda: load.load(spark, read_lines(spark, f"{folder}/log"), f"{folder}/tables"),
    }
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        took[name] = round(time.perf_counter() - start, 2)
        print(name, took[name], flush=True)
    print(json.dumps({"metric": "log_lines", "value": lines, "unit": "lines", "seconds": took, "lines_per_second": {k: round(lines / v) for k, v in took.items()}}))


if __name__ == "__main__":
    main()
