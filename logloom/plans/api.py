"""The read queries: DataFrames over the window, prediction and score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.ranking import by_day, running
from logloom.functions.text import detector_label

MAX_LIMIT, MAX_TEMPLATES = 5000, 200


def health(events: DataFrame | None, windows: DataFrame, scores: DataFrame) -> DataFrame:
    """Row counts; without events theirs is that of the windows, as each event is in one window."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))  # noqa: E731  one row each
    counted = windows.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("events")) if events is None else one(events, "events")
    return counted.crossJoin(one(windows, "windows")).crossJoin(one(scores, "detector_scores")).withColumn("status", F.lit("ok"))


def detectors(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("f1"), "detector")


def first_anomalous(windows: DataFrame, predictions: DataFrame) -> DataFrame:
    """first_anomalous_index: place of the first anomalous window among the scored ones."""
    scored = windows.join(predictions.select("window_start"), "window_start", "left_semi")
    placed = running(scored, by_day(F.col("window_start")), [F.col("window_start")])
    return placed.agg(F.min(F.when(F.col("is_anomalous"), F.col("position") - 1)).alias("first_anomalous_index"))


def summary(windows: DataFrame, predictions: DataFrame) -> DataFrame:
    if windows.isEmpty():
        raise ValueError("no windows")
    head = windows.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if("is_anomalous").alias("anomalous_windows"),
        F.min("window_start").alias("first_window"),
        F.max("window_start").alias("last_window"),
        F.sum("event_count").alias("events"),
    )
    scored = predictions.agg(F.min("window_start").alias("first_scored"), F.max("window_start").alias("last_scored"), F.count_distinct("window_start").alias("scored_windows"))
    return head.crossJoin(scored).crossJoin(first_anomalous(windows, predictions))


def detector_flags(predictions: DataFrame) -> DataFrame:
    """window_start and a map of detector names to their flags."""
    entry = F.struct(detector_label(F.col("detector"), F.col("variant")), F.col("predicted"))
    return predictions.groupBy("window_start").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("flags"))


def windows_page(windows: DataFrame, predictions: DataFrame, limit: int = 500, offset: int = 0, scored_only: bool = False) -> DataFrame:
    """Windows in time order; unscored ones have an empty map, not one of negatives."""
    if not 1 <= limit <= MAX_LIMIT or offset < 0:
        raise ValueError(f"limit {limit} or offset {offset} out of range")
    joined = windows.join(detector_flags(predictions), "window_start", "left")
    if scored_only:
        joined = joined.filter(F.col("flags").isNotNull())
    none = F.create_map().cast("map<string,boolean>")
    shown = ("window_start", "event_count", "distinct_nodes", "distinct_templates", "error_rate", "alert_count", "is_anomalous")
    return joined.select(*shown, F.coalesce("flags", none).alias("detector_flags")).orderBy("window_start").offset(offset).limit(limit)


def window_templates(counts: DataFrame, templates: DataFrame, window_start: int, limit: int = 20) -> DataFrame:
    """The most frequent templates of one window."""
    if not 1 <= limit <= MAX_TEMPLATES:
        raise ValueError(f"limit {limit} out of range")
    own = counts.filter(F.col("window_start") == window_start)
    if own.isEmpty():
        raise ValueError(f"no window at {window_start}")
    joined = own.join(templates, "template_id").select("template_id", "template", "event_count")
    return joined.orderBy(F.desc("event_count"), "template").limit(limit)
