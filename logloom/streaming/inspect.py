"""What a checkpoint of the exact stream holds: clocks, and windows that are still open.

Read through Spark's state reader, so a stopped or running stream is looked into
without taking part in it; what is open is what a drain would emit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


def clocks(spark: SparkSession, checkpoint: str, lateness_seconds: int = 0) -> DataFrame:
    """partition, latest (event time), watermark and closed_through (end of the last closed window, 0 if none)."""
    latest = F.col("value.latest")
    return _state(spark, checkpoint, "clock").select(F.col("key.partition").alias("partition"), latest.alias("latest"), (latest - lateness_seconds).alias("watermark"), F.col("value.closed_through").alias("closed_through"))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """A row for each open window of each partition, with its counts so far."""
    v = lambda c: F.col(f"user_map_value.{c}")
    rows = _state(spark, checkpoint, "open")
    names = [f.name for f in rows.schema["user_map_value"].dataType.fields if f.name not in ("produced_ms", "n_nodes", "n_templates", "chunks")]
    return rows.select(
        F.col("key.partition").alias("partition"), F.col("user_map_key.window_start").alias("window_start"), *(v(c).alias(c) for c in names),
        v("n_nodes").alias("distinct_nodes"), v("n_templates").alias("distinct_templates"),
    )
