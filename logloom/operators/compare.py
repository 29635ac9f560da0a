"""Comparison of two window tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parity(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: windows compared, missing on a side, and with different values."""
    a = left.select(F.col(key).alias("_k"), F.struct(*columns).alias("_a"))
    b = right.select(F.col(key).alias("_m"), F.struct(*columns).alias("_b"))
    both = a.join(b, F.col("_k") == F.col("_m"), "full_outer")
    return both.agg(
        F.count_if(F.col("_k").isNotNull() & F.col("_m").isNotNull()).alias("compared"),
        F.count_if(F.col("_m").isNull()).alias("missing"),
        F.count_if(F.col("_k").isNull()).alias("unexpected"),
        F.count_if(F.col("_k").isNotNull() & F.col("_m").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("different"),
    )
