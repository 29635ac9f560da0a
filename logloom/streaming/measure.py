"""Throughput and delay of the exact stream; each run has folders of its own."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import aggregate
from logloom.sources import topic
from logloom.streaming import exact, replay, sink


def _stream(spark: SparkSession, folder: str, window_seconds: int, partitions: int) -> DataFrame:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    events = replay.parsed_events(replay.topic_stream(spark, f"{folder}/topic"))
    drains = spark.readStream.schema(replay.DRAINS).parquet(f"{folder}/drains")
    return exact.exact_stream(events.unionByName(drains, allowMissingColumns=True), window_seconds, partitions=partitions)


def throughput_run(spark: SparkSession, lines: DataFrame, window_seconds: int = 60, partitions: int = exact.PARTITIONS) -> dict[str, float]:
    """Drain a topic that already holds all lines: the run's counters, its seconds and events a second.

    The time runs from the start of the query to its end; writing the topic isn't in it.
    """
    folder = sink.shared_folder(spark)
    replay.produce(lines, f"{folder}/topic", window_seconds)
    replay.drain(spark, f"{folder}/drains", partitions)
    start = time.perf_counter()
    query = sink.run_available(_stream(spark, folder, window_seconds, partitions), folder)
    seconds = time.perf_counter() - start
    out = sink.progress(query)
    events = out.get("records", 0) - out.get("rejected", 0)
    return out | {"seconds": seconds, "events_per_second": events / seconds}


def _member(spark: SparkSession, folder: str, member: int, members: int, window_seconds: int, partitions: int) -> dict[str, float]:
    """One member of a group: a query of its own over its partitions, into the group's sink."""
    own = tuple(p for p in range(partitions) if p % members == member)
    events = replay.parsed_events(topic.topic_stream(spark, f"{folder}/topic", partitions=own))
    drains = spark.readStream.schema(replay.DRAINS).parquet(f"{folder}/drains").filter(F.col("partition").isin(*own))
    stream = exact.exact_stream(events.unionByName(drains, allowMissingColumns=True), window_seconds, partitions=partitions)
    started = time.time()
    query = sink.run_available(stream, f"{folder}/member={member}")
    return sink.progress(query) | {"member": member, "started": started, "ended": time.time()}


def members_run(spark: SparkSession, lines: DataFrame, members: int, window_seconds: int = 60, partitions: int = exact.PARTITIONS) -> dict[str, float]:
    """Drain a topic by several queries at once, each over its own partitions: their totals, the span from
    the first one's start to the last one's end, events a second, and the largest member over the smallest."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", exact.PROVIDER)
    folder = sink.shared_folder(spark)
    replay.produce_partitioned(lines, f"{folder}/topic", partitions, window_seconds)
    replay.drain(spark, f"{folder}/drains", partitions)
    with ThreadPoolExecutor(members) as pool:
        found = list(pool.map(lambda m: _member(spark, folder, m, members, window_seconds, partitions), range(members)))
    total = {k: sum(f.get(k, 0) for f in found) for k in ("records", "rejected", "windows", "late_events")}
    span = max(f["ended"] for f in found) - min(f["started"] for f in found)
    sizes = [f.get("records", 0) for f in found]
    return total | {"members": members, "span_seconds": span, "events_per_second": (total["records"] - total["rejected"]) / span, "skew": max(sizes) / max(min(sizes), 1)}


def members_runs(spark: SparkSession, lines: DataFrame, members: int, runs: int = 3, window_seconds: int = 60, partitions: int = exact.PARTITIONS) -> dict:
    """Several such runs in new folders: each one's row, and the medians of rate and span. All must agree on windows and late events."""
    if not 1 <= members <= partitions:
        raise ValueError(f"members must be between 1 and {partitions}, got {members}")
    rows = [members_run(spark, lines, members, window_seconds, partitions) for _ in range(runs)]
    out: dict = {"runs": rows, "median_events_per_second": median(r["events_per_second"] for r in rows), "median_span_seconds": median(r["span_seconds"] for r in rows)}
    for name in ("windows", "late_events"):
        if len({r[name] for r in rows}) > 1:
            raise RuntimeError(f"runs differ in {name}: {[r[name] for r in rows]}")
        out[name] = rows[0][name]
    return out


def delay_run(
    spark: SparkSession, lines: DataFrame, speed: float, window_seconds: int = 60, partitions: int = exact.PARTITIONS, sleep: Callable[[float], None] = time.sleep
) -> dict[str, float | None]:
    """Replay the lines at `speed` times event time beside a running stream: slices, windows, and
    the median and 95th percentile of the milliseconds from a window's last record to its row.

    Windows that are open at the end are closed by drain records once all else is through.
    """
    folder = sink.shared_folder(spark)
    for name, schema in (("topic", replay.TOPIC), ("drains", replay.DRAINS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")

    def indexed(batch: DataFrame) -> DataFrame:
        lag = F.unix_millis(F.current_timestamp()) - F.unix_millis("produced_at")
        return exact.closed_windows(batch, window_seconds).select("window_start", "event_count", lag.alias("ingest_lag_ms"))

    stream = _stream(spark, folder, window_seconds, partitions)
    query = stream.writeStream.foreachBatch(sink.upsert(f"{folder}/out", indexed)).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        slices = replay.paced(lines, f"{folder}/topic", speed, window_seconds, sleep)
        query.processAllAvailable()
        replay.drain(spark, f"{folder}/drains", partitions)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.schema("window_start bigint, event_count bigint, ingest_lag_ms bigint").parquet(f"{folder}/out")
    found = aggregate.delay_percentiles(rows, "ingest_lag_ms").first()
    return {"slices": slices, "windows": found["n"] or 0, "median_ms": found["median"], "p95_ms": found["p95"]}
