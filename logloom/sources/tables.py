"""Parquet tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table up to which it is dealt out anew; a larger one is read as it is split.
SPREAD_BYTES = 1 << 30
#: Bytes of a dealt-out partition, and of a larger table's largest one from which that is dealt out too.
DEALT_BYTES, LARGEST_BYTES = 8 << 20, 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out anew where few of its partitions hold most of its rows.

    A small file is otherwise a single task's work, and so is a row group of any size: a
    scan cuts a file by bytes, but all rows of a group go to one of the cuts and the others are
    empty. So the rows of the partitions are counted (a job on the files' footers, no column is
    read) where their number alone doesn't show it. df is a scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    size = int(str(plan.optimizedPlan().stats().sizeInBytes()))
    few = plan.toRdd().getNumPartitions() < cores
    if few and size <= SPREAD_BYTES:
        uneven = True
    else:
        held = df.select().groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
        most, rows = held.agg(F.max("n"), F.sum("n")).first()
        share = (most or 0) / (rows or 1)
        uneven = share * cores > 1.25 if size <= SPREAD_BYTES else share * size > LARGEST_BYTES
    return df.repartition(max(cores, size // DEALT_BYTES)) if uneven else df


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The table, or columns of it."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(table.select(*columns) if columns else table)
