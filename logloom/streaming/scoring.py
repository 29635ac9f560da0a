"""Scores of closed windows, and the statistics file that they come from."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.time import window_id
from logloom.operators.detect import ZScore, severity_rule
from logloom.operators.features import build_matrix
from logloom.sources.schemas import DOCUMENT, WINDOW_COUNTS, require

VERSION = 1


def score_windows(windows: DataFrame, stats: ZScore) -> DataFrame:
    """Add zscore, severity_flag, zscore_flag and flagged (either)."""
    require(windows, stats.features)
    out = windows.withColumns({"zscore": stats.score(), "severity_flag": severity_rule(windows)})
    out = out.withColumn("zscore_flag", F.col("zscore") >= F.lit(stats.threshold))
    return out.withColumn("flagged", F.col("severity_flag") | F.col("zscore_flag"))


def documents(scored: DataFrame) -> DataFrame:
    """The index's rows, keyed by window_id; produced_at and ingest_lag_ms where known."""
    end = F.col("window_start") + F.col("window_seconds")
    out = scored.withColumns({"window_id": window_id(F.col("window_start")), "window_end": window_id(end), "window_start": window_id(F.col("window_start"))})
    extra = []
    if "produced_at" in scored.columns:
        now = F.current_timestamp()
        lag = F.unix_millis(now) - F.unix_millis("produced_at")
        extra = [F.col("produced_at"), now.alias("indexed_at"), lag.alias("ingest_lag_ms")]
    return out.select(*DOCUMENT, *extra)


def export_statistics(windows: DataFrame, counts: DataFrame, window_seconds: int = 60, train_fraction: float = 0.7) -> str:
    """JSON of the z-score statistics of the training windows' base features; a null threshold flags nothing."""
    matrix = build_matrix(windows, counts, train_fraction, templates=0)
    model = ZScore.fit(matrix)
    head = {"version": VERSION, "window_seconds": window_seconds, "train_fraction": train_fraction}
    return json.dumps(head | {"feature_names": list(model.features), "mean": list(model.mean), "std": list(model.std), "threshold": model.threshold if math.isfinite(model.threshold) else None}, indent=2, allow_nan=False)


def load_statistics(text: str) -> ZScore:
    raw = json.loads(text)
    if raw.get("version") != VERSION:
        raise ValueError(f"statistics version {raw.get('version')}, expected {VERSION}")
    if tuple(raw["feature_names"]) != WINDOW_COUNTS:
        raise ValueError("statistics were made for other features")
    return ZScore(tuple(raw["feature_names"]), tuple(raw["mean"]), tuple(raw["std"]), math.inf if raw["threshold"] is None else raw["threshold"])
