"""Chronological splits and the feature matrix; nothing is chosen on test data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.ranking import by_day, running
from logloom.sources.schemas import WINDOW_COUNTS

#: Features that restate severities.
SEVERITY_FEATURES = ("info_count", "warning_count", "error_count", "severe_count", "fatal_count", "failure_count", "error_rate")


def _checked(name: str, fraction: float) -> float:
    if not 0 < fraction < 1:
        raise ValueError(f"{name} must be between 0 and 1, got {fraction}")
    return fraction


def split_parts(windows: DataFrame, train_fraction: float = 0.7, fit_fraction: float = 0.8) -> DataFrame:
    """Add position (from 0 in time order) and part: 'fit', 'validation' or 'test'.

    The first int(n * train_fraction) windows train; of those the first
    int(n_train * fit_fraction) fit and the rest validate.
    """
    _checked("train_fraction", train_fraction)
    _checked("fit_fraction", fit_fraction)
    n = windows.count()
    n_train = int(n * train_fraction)
    if not n:
        raise ValueError("No windows found")
    if not 0 < n_train < n:
        raise ValueError(f"{n} windows leave an empty side at {train_fraction}")
    n_fit = int(n_train * fit_fraction)
    placed = running(windows, by_day(F.col("window_start")), [F.col("window_start")]).withColumn("position", F.col("position") - 1)
    part = F.when(F.col("position") < n_fit, "fit").when(F.col("position") < n_train, "validation").otherwise("test")
    return placed.withColumn("part", part)


def cutoff(parts: DataFrame) -> int:
    """Start of the first test window."""
    return parts.filter("part = 'test'").agg(F.min("window_start")).first()[0]


def top_templates(counts: DataFrame, before: int, k: int = 20) -> DataFrame:
    """The k most frequent templates of windows that start before `before`."""
    if k < 0:
        raise ValueError(f"top_templates must not be negative, got {k}")
    train = counts.filter(F.col("window_start") < before)
    return train.groupBy("template_id").agg(F.sum("event_count").alias("total")).orderBy(F.desc("total"), "template_id").limit(k)


@dataclass(frozen=True)
class Matrix:
    """A wide table (window_start, part, label, features) and its feature names."""

    rows: DataFrame
    features: tuple[str, ...]

    def without(self, *names: str) -> Matrix:
        if unknown := [n for n in names if n not in self.features]:
            raise ValueError(f"unknown features {unknown}")
        return Matrix(self.rows.drop(*names), tuple(f for f in self.features if f not in names))

    def severity_free(self) -> Matrix:
        return self.without(*SEVERITY_FEATURES)


def build_matrix(windows: DataFrame, counts: DataFrame, train_fraction: float = 0.7, templates: int = 20, fit_fraction: float = 0.8) -> Matrix:
    """Base counts and one column tpl_<id> per frequent training template, missing counts 0."""
    parts = split_parts(windows, train_fraction, fit_fraction)
    ids = [r["template_id"] for r in top_templates(counts, cutoff(parts), templates).collect()]  # at most `templates`
    base = parts.select("window_start", "part", F.col("is_anomalous").alias("label"), *(F.col(c).cast("double").alias(c) for c in WINDOW_COUNTS))
    names = [f"tpl_{i}" for i in ids]
    if ids:
        # Conditional sums with the values known, so that no pass over the data is needed to find them.
        wide = counts.filter(F.col("template_id").isin(ids)).groupBy("window_start").pivot("template_id", ids).agg(F.sum("event_count"))
        wide = wide.select("window_start", *(F.col(i).cast("double").alias(n) for i, n in zip(ids, names, strict=True)))
        base = base.join(wide, "window_start", "left").fillna(0.0, names)
    return Matrix(base, (*WINDOW_COUNTS, *names))
