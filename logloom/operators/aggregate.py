"""Tumbling-window aggregates over parsed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.ranking import running
from logloom.functions.time import window_floor
from logloom.operators.parse import ERROR_SEVERITIES, SEVERITIES


def severity_counts(n: Column | None = None) -> list[Column]:
    """One count per severity; n: occurrences of a row (1 unless given)."""
    of = F.lit(1) if n is None else n
    return [F.sum(F.when(F.col("severity") == s, of).otherwise(0)).cast("long").alias(f"{s.lower()}_count") for s in SEVERITIES]


def error_rate() -> Column:
    return sum((F.col(f"{s.lower()}_count") for s in ERROR_SEVERITIES), F.lit(0)) / F.col("event_count").cast("double")


def counted(events: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Events counted by (window_start, node, template_id, severity, is_alert) as n, which partial
    aggregation does before the shuffle: a hot window is already reduced when its rows meet."""
    keyed = events.withColumn("window_start", window_floor(F.col("epoch"), window_seconds))
    return keyed.groupBy("window_start", "node", "template_id", "severity", "is_alert").agg(F.count(F.lit(1)).alias("n"))


def without_nodes(counted: DataFrame) -> DataFrame:
    """Counted events without their nodes, which are most of their keys."""
    return counted.groupBy("window_start", "template_id", "severity", "is_alert").agg(F.sum("n").alias("n"))


def distinct_nodes(counted: DataFrame) -> DataFrame:
    """Exact number of nodes of each window."""
    return counted.groupBy("window_start").agg(F.count_distinct("node").alias("distinct_nodes"))


def features_of(counted: DataFrame, window_seconds: int, nodes: DataFrame | None = None) -> DataFrame:
    """window_features out of counted events; the exact distinct counts run over what is left of a window.

    nodes: their distinct_nodes, where counted comes without nodes. Two distinct counts in one grouping
    make three rows of each counted one, so this is the way for counted events that are stored.
    """
    out = counted.groupBy("window_start").agg(
        F.sum("n").alias("event_count"),
        *([F.count_distinct("node").alias("distinct_nodes")] if nodes is None else []),
        F.count_distinct("template_id").alias("distinct_templates"),
        *severity_counts(F.col("n")),
        F.sum(F.when(F.col("is_alert"), F.col("n")).otherwise(0)).cast("long").alias("alert_count"),
        F.bool_or("is_alert").alias("is_anomalous"),
    )
    out = out if nodes is None else out.join(nodes, "window_start")
    out = out.withColumn("error_rate", error_rate()).withColumn("window_seconds", F.lit(window_seconds))
    return out.select(
        "window_seconds", "window_start", "event_count", "distinct_nodes", "distinct_templates",
        *(f"{s.lower()}_count" for s in SEVERITIES), "error_rate", "alert_count", "is_anomalous",
    )


def window_features(events: DataFrame, window_seconds: int = 60) -> DataFrame:
    """One row per non-empty window; window_start in epoch seconds."""
    return features_of(counted(events, window_seconds), window_seconds)


#: Size of the sketches of window_sketches: 2 to this power of registers.
LG_K = 14
#: Standard error of a sketch's count, as a share of it, at LG_K.
SKETCH_ERROR = 1.04 / 2 ** (LG_K / 2)


def window_sketches(events: DataFrame, window_seconds: int = 60, lg_k: int = LG_K) -> DataFrame:
    """Windows in parts that add up: counts, and HyperLogLog sketches of nodes and templates.

    Unlike window_features these roll up into wider windows, and into each other where a
    window's events come in several loads; distinct counts are then estimates.
    """
    return counted(events, window_seconds).groupBy("window_start").agg(
        F.sum("n").alias("event_count"),
        *severity_counts(F.col("n")),
        F.sum(F.when(F.col("is_alert"), F.col("n")).otherwise(0)).cast("long").alias("alert_count"),
        F.hll_sketch_agg("node", F.lit(lg_k)).alias("node_sketch"),
        F.hll_sketch_agg("template_id", F.lit(lg_k)).alias("template_sketch"),
    )


def rolled_up(sketches: DataFrame, window_seconds: int) -> DataFrame:
    """Windows of a multiple of the sketched seconds, without the events."""
    keyed = sketches.withColumn("window_start", window_floor(F.col("window_start"), window_seconds))
    sums = ("event_count", *(f"{s.lower()}_count" for s in SEVERITIES), "alert_count")
    return keyed.groupBy("window_start").agg(
        *(F.sum(c).alias(c) for c in sums),
        F.hll_union_agg("node_sketch").alias("node_sketch"),
        F.hll_union_agg("template_sketch").alias("template_sketch"),
    )


def sketched_features(sketches: DataFrame, window_seconds: int) -> DataFrame:
    """The columns of window_features; distinct counts are estimates of SKETCH_ERROR."""
    out = sketches.withColumns(
        {
            "window_seconds": F.lit(window_seconds),
            "distinct_nodes": F.hll_sketch_estimate("node_sketch"),
            "distinct_templates": F.hll_sketch_estimate("template_sketch"),
            "error_rate": error_rate(),
            "is_anomalous": F.col("alert_count") > 0,
        }
    )
    return out.select(
        "window_seconds", "window_start", "event_count", "distinct_nodes", "distinct_templates",
        *(f"{s.lower()}_count" for s in SEVERITIES), "error_rate", "alert_count", "is_anomalous",
    )


def counts_of(counted: DataFrame, window_seconds: int) -> DataFrame:
    """template_counts out of counted events."""
    out = counted.groupBy("window_start", "template_id").agg(F.sum("n").alias("event_count"))
    return out.select(F.lit(window_seconds).alias("window_seconds"), "window_start", "template_id", "event_count")


def template_counts(events: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Long counts: window_seconds, window_start, template_id, event_count."""
    keyed = events.withColumn("window_start", window_floor(F.col("epoch"), window_seconds))
    out = keyed.groupBy("window_start", "template_id").agg(F.count(F.lit(1)).alias("event_count"))
    return out.select(F.lit(window_seconds).alias("window_seconds"), "window_start", "template_id", "event_count")


def template_catalog(events: DataFrame) -> DataFrame:
    """template_id, template, first_seen (epoch of its first event)."""
    return events.groupBy("template_id").agg(F.min("template").alias("template"), F.min("epoch").alias("first_seen"))


def daily_histogram(windows: DataFrame, flagged: Column) -> DataFrame:
    day = F.date_format(F.timestamp_seconds("window_start"), "yyyy-MM-dd")
    return windows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("windows"), F.count_if(flagged).alias("flagged"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


def delay_percentiles(delays: DataFrame, column: str) -> DataFrame:
    """Median and the value at rank floor(0.95 n) (from 0, the last at most).

    Values are counted first, so equal delays are one row of the ranking.
    """
    counted = delays.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # Buckets are powers of two, negative values before positive ones.
    size = F.floor(F.log2(F.greatest(F.abs(F.col("v")), F.lit(1)).cast("double"))) + 1
    ranked = running(counted, size * F.signum(F.col("v").cast("double")), [F.col("v")], {"upto": F.col("n")})
    total = counted.agg(F.sum("n").alias("total"))
    placed = ranked.crossJoin(F.broadcast(total))  # one row
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    n = F.col("total")
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2.0
    return placed.agg(F.max("total").alias("n"), middle.alias("median"), at(F.least(n - 1, F.floor(n * F.lit(0.95)))).cast("double").alias("p95"))
