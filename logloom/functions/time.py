"""Event-time grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def checked_seconds(window_seconds: int) -> int:
    if window_seconds <= 0:
        raise ValueError(f"window_seconds must be positive, got {window_seconds}")
    return window_seconds


def window_floor(epoch: Column, window_seconds: int) -> Column:
    """Start (epoch seconds) of the tumbling window that holds epoch."""
    w = checked_seconds(window_seconds)
    return epoch - F.pmod(epoch, F.lit(w).cast("long"))


def window_id(start: Column) -> Column:
    """ISO-8601 name of a window start in UTC."""
    return F.concat(F.date_format(F.timestamp_seconds(start), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def iso_millis(millis: Column) -> Column:
    return F.concat(F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))
