"""Log lines: text files with line numbers, and the events table as a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.sources.scratch import checkpointed
from logloom.sources.tables import read_table

#: Least error values of a failure and of an alert in the events table.
FAILURE_VALUE, ALERT_VALUE = 100, 200


#: Blocks of a log up to which their offsets, a row each, are sent to the tasks (some 20 MB
#: at most); beyond, lines are joined with them by a shuffle.
BROADCAST_BLOCKS = 100_000


def read_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """source_file, line_no (from 1), value: lines end at \\n alone.

    A block's lines are numbered by their order in the scan; a first pass counts
    the lines of the blocks before. So no text is shuffled or sorted, and a file
    is not pulled through one task. Should the second scan cut the files otherwise, as
    with other cores meanwhile, it fails and doesn't number wrongly. limit: the first
    lines of each file.
    """
    at = F.monotonically_increasing_id()
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"), at.alias("_at"), F.spark_partition_id().alias("_part"), "value")
    )
    keys = ["source_file", "_block", "_part"]
    counts = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(counts.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")))
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_BLOCKS else starts
    shift = F.coalesce("_shift", F.raise_error(F.lit("the log was cut otherwise than when its lines were counted; read it again")).cast("long"))
    out = lines.join(starts, keys, "left").select("source_file", (F.col("_at") + shift).alias("line_no"), "value")
    return out if limit is None else out.filter(F.col("line_no") <= limit)


def severity_of_event(event_type: Column, value: Column) -> Column:
    return (
        F.when(event_type == "view", "INFO")
        .when(event_type == "click", "WARNING")
        .when(event_type == "signup", "ERROR")
        .when(event_type == "purchase", "SEVERE")
        .when(value >= FAILURE_VALUE, "FAILURE")
        .otherwise("FATAL")
    )


def events_as_lines(events: DataFrame) -> DataFrame:
    """source_file, line_no, value: the events table written as log lines."""
    at = F.col("ts").cast("timestamp")
    stamp = F.date_format(at, "yyyy-MM-dd-HH.mm.ss.SSSSSS")
    node = F.col("user_id").cast("string")
    alert = (F.col("event_type") == "error") & (F.col("value") >= ALERT_VALUE)
    message = F.concat(F.col("event_type"), F.lit(" k="), F.coalesce(F.get_json_object("props", "$.k"), F.lit("")), F.lit(" user "), node)
    value = F.concat_ws(
        " ",
        F.when(alert, "ALERT").otherwise("-"),
        F.unix_timestamp(at).cast("string"),
        F.translate(F.substring_index(stamp, "-", 3), "-", "."),
        node,
        stamp,
        node,
        F.lit("RAS"),
        F.lit("APP"),
        severity_of_event(F.col("event_type"), F.col("value")),
        message,
    )
    return events.select(F.lit("events").alias("source_file"), (F.col("event_id") + 1).alias("line_no"), value.alias("value"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_lines(read_table(spark, sf_dir, "events"))
