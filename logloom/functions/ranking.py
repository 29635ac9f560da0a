"""Global positions and running sums without a global sort in one task.

Rows are ranked inside buckets that follow the order, and each bucket starts
where the ones before it end. Only the buckets' totals, a few rows, are ordered
in one place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, bucket: Column, order: list[Column], sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Add position (from 1) and a running sum for each entry of sums.

    bucket: a number that never falls along the order, with a bounded number of values.
    """
    sums = dict(sums or {})
    rows = df.withColumn("_b", bucket).withColumns({f"_x_{k}": v for k, v in sums.items()})
    totals = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(f"_x_{k}").alias(f"_t_{k}") for k in sums))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("_b").alias("_sb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *(F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_s_{k}") for k in sums),
    )
    inside = Window.partitionBy("_b").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(starts, rows["_b"].eqNullSafe(starts["_sb"]))
    out = out.withColumn("position", (F.col("_n0") + F.row_number().over(inside)).cast("long"))
    out = out.withColumns({k: F.col(f"_s_{k}") + F.sum(f"_x_{k}").over(upto) for k in sums})
    return out.drop("_b", "_sb", "_n0", *(f"{p}{k}" for k in sums for p in ("_x_", "_s_")))


def by_day(epoch: Column) -> Column:
    """Bucket of a time order: the day."""
    return F.floor(epoch / 86400)


def by_value(df: DataFrame, column: str, buckets: int = 64) -> Column:
    """Bucket of a falling order by value: between approximate quantiles."""
    cuts = df.agg(F.percentile_approx(column, [i / buckets for i in range(1, buckets)], 1000).alias("q")).first()["q"] or []
    return -sum((F.when(F.col(column) >= F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))


def quantile(df: DataFrame, column: str, share: float) -> float:
    """The value at share of the way from the least to the largest, linear between two neighbours.

    Equal values are counted first and ranked in buckets, so no task or buffer holds all of them.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = running(counted, -by_value(counted, "v"), [F.col("v")], {"upto": F.col("n")})
    n = counted.agg(F.sum("n")).first()[0]
    at = (n - 1) * share
    low, high = (upto.filter(F.col("upto") > int(k)).agg(F.min("v")).first()[0] for k in (at, min(at + 1, n - 1)))
    return low + (high - low) * (at - int(at))
