"""Replay of a log into a topic: a folder of Parquet files, or Kafka where its connector is."""

from __future__ import annotations

import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.time import window_floor
from logloom.operators.parse import good, parse
from logloom.sources import topic as topics

TOPIC = "key string, value string, source_file string, line_no bigint, produced_at timestamp"
DRAINS = "partition int, drain boolean"
#: Settings of the producer.
KAFKA = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "lz4", "kafka.linger.ms": "10", "kafka.batch.size": "262144"}


def records(lines: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Good lines as records keyed by their window; rejects never reach the topic."""
    parsed = parse(lines)
    key = window_floor(F.col("epoch"), window_seconds).cast("string")
    return parsed.filter(F.col("reason").isNull()).select(key.alias("key"), "value", "source_file", "line_no", F.current_timestamp().alias("produced_at"))


def produce(lines: DataFrame, topic: str, window_seconds: int = 60, files: int | None = None) -> None:
    """Append records to a topic folder; with files, in so many runs of lines."""
    out = records(lines, window_seconds)
    if files:
        out = out.repartitionByRange(files, "source_file", "line_no")
    out.write.mode("append").parquet(topic)


def produce_partitioned(lines: DataFrame, topic: str, partitions: int = 6, window_seconds: int = 60, partition: Column | None = None, files: int | None = None) -> dict[int, int]:
    """Append records to a partitioned topic (sources.topic); returns the ends of its partitions.

    A record's partition comes from its key, so that a window is whole in one of them, or
    is `partition`, an expression over the parsed line.
    """
    parsed = parse(lines).filter(F.col("reason").isNull())
    key = window_floor(F.col("epoch"), window_seconds).cast("string")
    where = topics.partition_of(key, partitions) if partition is None else partition
    out = parsed.select(key.alias("key"), "value", "source_file", "line_no", F.current_timestamp().alias("produced_at"), where.alias("partition"))
    return topics.append(out, topic, files)


def paced_partitioned(lines: DataFrame, topic: str, speed: float, partitions: int = 6, window_seconds: int = 60, sleep: Callable[[float], None] = time.sleep) -> int:
    """Append the log to a partitioned topic slice by slice, a window's time each, at `speed` times event time; returns the slices."""
    if speed <= 0:
        raise ValueError(f"speed must be positive, got {speed}")
    spark, stage = lines.sparkSession, f"{topic.rstrip('/')}-staged-{uuid4().hex}"
    records(lines, window_seconds).drop("produced_at").repartition("key").write.partitionBy("key").parquet(stage)
    starts = sorted(int(r["key"]) for r in spark.read.schema(TOPIC).option("basePath", stage).parquet(stage).select("key").distinct().collect())  # one per window
    for i, start in enumerate(starts):
        if i:
            sleep((start - starts[i - 1]) / speed)
        own = spark.read.schema(TOPIC).option("basePath", stage).parquet(f"{stage}/key={start}").withColumn("produced_at", F.current_timestamp())
        topics.append(own.withColumn("partition", topics.partition_of(F.col("key"), partitions)), topic)
    at = spark._jvm.org.apache.hadoop.fs.Path(stage)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(starts)


def paced(lines: DataFrame, topic: str, speed: float = 0.0, window_seconds: int = 60, sleep: Callable[[float], None] = time.sleep) -> int:
    """Append the log to a topic slice by slice at `speed` times event time; returns the slices.

    Speed 0 appends everything at once. A slice is one window's time. The records are
    staged by window, so a slice reads its own alone.
    """
    if speed < 0:
        raise ValueError(f"speed must not be negative, got {speed}")
    if speed == 0:
        produce(lines, topic, window_seconds)
        return 1
    spark, stage = lines.sparkSession, f"{topic.rstrip('/')}-staged-{uuid4().hex}"
    records(lines, window_seconds).drop("produced_at").repartition("key").write.partitionBy("key").parquet(stage)
    kept = spark.read.schema(TOPIC).option("basePath", stage).parquet(stage)
    starts = sorted(int(r["key"]) for r in kept.select("key").distinct().collect())  # one per window of the replay
    for i, start in enumerate(starts):
        if i:
            sleep((start - starts[i - 1]) / speed)
        own = spark.read.schema(TOPIC).option("basePath", stage).parquet(f"{stage}/key={start}")
        own.withColumn("produced_at", F.current_timestamp()).select(*kept.columns).write.mode("append").parquet(topic)
    at = spark._jvm.org.apache.hadoop.fs.Path(stage)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(starts)


def produce_kafka(lines: DataFrame, servers: str, topic: str, window_seconds: int = 60) -> None:
    """The same into Kafka; needs Spark's Kafka connector on the class path."""
    records(lines, window_seconds).select("key", "value").write.format("kafka").options(**KAFKA).option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def topic_stream(spark: SparkSession, topic: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TOPIC)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(topic)


def drain(spark: SparkSession, folder: str, partitions: int) -> None:
    """Append one record per partition that ends a bounded replay: partition, drain."""
    spark.range(partitions).select(F.col("id").cast("int").alias("partition"), F.lit(True).alias("drain")).coalesce(1).write.mode("append").parquet(folder)


def drain_stream(spark: SparkSession, folder: str, partitions: int) -> DataFrame:
    """The drain records as a stream."""
    drain(spark, folder, partitions)
    return spark.readStream.schema(DRAINS).parquet(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 5000, group: str = "") -> DataFrame:
    """Records of a Kafka topic from its start; offsets live in the query's checkpoint, the group only names its readers."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": per_trigger}
    raw = spark.readStream.format("kafka").options(**options | ({"groupIdPrefix": group} if group else {})).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("topic").alias("source_file"), F.col("offset").alias("line_no"), F.col("timestamp").alias("produced_at"), "partition", "offset")


def parsed_events(stream: DataFrame) -> DataFrame:
    """Events of a stream of records, with the partition and offset that they came from where the
    source has them; lines that don't parse are filtered, and counted for the run's progress."""
    parsed = parse(stream, keep=("produced_at", *(c for c in ("partition", "offset") if c in stream.columns)))
    return good(parsed.observe("parse", F.count(F.lit(1)).alias("records"), F.count_if(F.col("reason").isNotNull()).alias("rejected")))


def event_time_span(lines: DataFrame) -> DataFrame:
    """first, last and span (at least 1) of the epochs of the lines that parse."""
    span = good(parse(lines)).agg(F.min("epoch").alias("first"), F.max("epoch").alias("last"))
    return span.withColumn("span", F.greatest(F.col("last") - F.col("first"), F.lit(1).cast("long")))
