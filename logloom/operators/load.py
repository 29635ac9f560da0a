"""Idempotent loads and replaced slices over Parquet tables.

The loaded tables are stored by run and by a bucket of the source file. Closing the
run's audit row is the one commit of a load: `table` shows rows of closed runs
alone, so a load that is lost at any point changes nothing that anybody sees, and the
next load removes what it left. Window tables are stored by size and day, and a
refresh rebuilds the days that runs since the last refresh touched.
"""

from __future__ import annotations

from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.time import window_floor
from logloom.operators import aggregate
from logloom.operators.parse import good, parse, rejects
from logloom.sources import schemas

KEYS = ("source_file", "line_no")


#: Source files of a load up to which the stored rows are narrowed to these files.
NAMED_FILES = 1000
#: Folders of a run, by a hash of the source file.
BUCKETS = 16
#: Tables that a load writes, and the schemas of all tables.
LOADED = ("log_events", "quarantined_lines", "event_templates")
TABLES = {
    "ingest_runs": schemas.RUNS, "event_templates": schemas.TEMPLATES, "log_events": schemas.LOG_EVENTS, "quarantined_lines": schemas.QUARANTINED,
    "window_features": schemas.WINDOW_FEATURES, "window_template_counts": schemas.TEMPLATE_COUNTS, "window_refreshes": schemas.REFRESHES,
    "detector_scores": schemas.SCORES, "window_predictions": schemas.PREDICTIONS,
}


def _path(spark: SparkSession, path: str):
    """The path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    at, store = _path(spark, path)
    store.delete(at, True)


def stored(spark: SparkSession, warehouse: str, name: str, schema: str) -> DataFrame:
    """All rows of a table, empty where nothing was written yet."""
    at, store = _path(spark, f"{warehouse}/{name}")
    return spark.read.schema(schema).parquet(f"{warehouse}/{name}") if store.exists(at) else spark.createDataFrame([], schema)


def table(spark: SparkSession, warehouse: str, name: str, schema: str | None = None) -> DataFrame:
    """A table of the warehouse; of a loaded one the rows of closed runs."""
    schema = schema or TABLES[name]
    if name not in LOADED:
        return stored(spark, warehouse, name, schema)
    rows = stored(spark, warehouse, name, f"{schema}, run_id bigint, file_bucket int")
    return rows.filter(F.col("run_id").isin(closed_runs(spark, warehouse))).drop("run_id", "file_bucket")


def closed_runs(spark: SparkSession, warehouse: str) -> list[int]:
    """Ids of the runs that came to their end; a row a load."""
    return [r[0] for r in runs(spark, warehouse).filter("finished_at IS NOT NULL").select("run_id").collect()]


def init(spark: SparkSession, warehouse: str, reset: bool = False) -> list[str]:
    """Create the tables that there aren't, empty; with reset all of them anew. Returns their names."""
    for name, schema in TABLES.items():
        at, store = _path(spark, f"{warehouse}/{name}")
        if reset:
            store.delete(at, True)
        if not store.exists(at):
            extra = ", run_id bigint, file_bucket int" if name in LOADED else ""
            spark.createDataFrame([], schema + extra).write.parquet(f"{warehouse}/{name}")
    return list(TABLES)


def absent(new: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """Rows of new whose keys existing doesn't have: insert, or do nothing on conflict."""
    return new.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def runs(spark: SparkSession, warehouse: str) -> DataFrame:
    """The audit table: one row per run, closed where the run came to its end."""
    states = stored(spark, warehouse, "ingest_runs", schemas.RUNS)
    newest = F.max_by(F.struct("*"), F.coalesce("finished_at", F.lit(datetime(1970, 1, 1, tzinfo=UTC))))
    return states.groupBy(F.col("run_id").alias("_run")).agg(newest.alias("state")).select("state.*")


def _audit(spark: SparkSession, warehouse: str, *row) -> None:
    spark.createDataFrame([row], schemas.RUNS).coalesce(1).write.mode("append").parquet(f"{warehouse}/ingest_runs")


def _bucket(source_file) -> Column:
    return F.pmod(F.xxhash64(source_file), F.lit(BUCKETS)).cast("int")


def _lost_runs(spark: SparkSession, warehouse: str) -> None:
    """Remove what runs that never closed have left."""
    for r in runs(spark, warehouse).filter("finished_at IS NULL").select("run_id").collect():
        for name in LOADED:
            _delete(spark, f"{warehouse}/{name}/run_id={r[0]}")


def load(spark: SparkSession, lines: DataFrame, warehouse: str) -> dict[str, int]:
    """Parse lines and append what the tables don't have yet; returns the counts.

    The parsed lines are staged once. Rows carry the run that wrote them and are seen
    once its audit row is closed, by a single write; a repeated load adds nothing. A load
    that failed midway, which leaves an open row in the audit table, is run again.
    Loads into one warehouse follow each other.
    """
    started = datetime.now(UTC)
    _lost_runs(spark, warehouse)
    run_id = (stored(spark, warehouse, "ingest_runs", schemas.RUNS).agg(F.max("run_id")).first()[0] or 0) + 1
    stage = f"{warehouse}/_staged-{uuid4().hex}"
    columns = [c.split()[0] for c in schemas.LOG_EVENTS.split(", ")]
    try:
        parsed = parse(lines)
        fits = F.col("reason").isNull()
        only = lambda c: F.when(fits, F.col(c)).alias(c)  # noqa: E731  rejects aren't masked
        kept = [c for c in columns if c not in ("source_file", "line_no")]
        parsed.select("source_file", "line_no", "reason", F.when(~fits, F.col("value")).alias("value"), *map(only, kept)).write.parquet(stage)
        staged = spark.read.parquet(stage)
        files = [r[0] for r in staged.select("source_file").distinct().limit(NAMED_FILES + 1).collect()]
        name = min(files, default=None)
        _audit(spark, warehouse, run_id, name, None, started, None, 0, 0, 0, 0)
        closed = closed_runs(spark, warehouse)

        def known(t: str) -> DataFrame:
            """The visible rows of the load's source files; whole runs and buckets are left unread."""
            rows = stored(spark, warehouse, t, f"{TABLES[t]}, run_id bigint, file_bucket int").filter(F.col("run_id").isin(closed))
            if len(files) <= NAMED_FILES:
                buckets = [r[0] for r in spark.createDataFrame([(f,) for f in files], "f string").select(_bucket(F.col("f"))).distinct().collect()]
                rows = rows.filter(F.col("file_bucket").isin(buckets) & F.col("source_file").isin(files))
            return rows

        def append(rows: DataFrame, t: str, bucket) -> int:
            at = f"{warehouse}/{t}/run_id={run_id}"
            rows.withColumn("file_bucket", bucket).write.partitionBy("file_bucket").parquet(at)
            return spark.read.schema(TABLES[t]).parquet(at).count()  # of file footers

        events, bad = good(staged), rejects(staged)
        seen = events.groupBy("template_id").agg(F.min("template").alias("template"), F.min("event_time").alias("first_seen"))
        append(absent(seen, table(spark, warehouse, "event_templates"), "template_id"), "event_templates", F.lit(0))
        append(absent(bad, known("quarantined_lines"), *KEYS), "quarantined_lines", _bucket(F.col("source_file")))
        n = append(absent(events.select(*columns), known("log_events"), *KEYS), "log_events", _bucket(F.col("source_file")))
        counts = staged.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("reason").isNull()).alias("parsed")).first()
    finally:
        _delete(spark, stage)
    out = {"lines_read": counts["read"], "rows_inserted": n, "rows_duplicate": counts["parsed"] - n, "lines_quarantined": counts["read"] - counts["parsed"]}
    _audit(spark, warehouse, run_id, name, None, started, datetime.now(UTC), *out.values())
    return out


def replace_slice(df: DataFrame, warehouse: str, name: str, window_seconds: int) -> None:
    """Replace the rows of one window size by df's; others stay. No rows leave no slice."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_seconds").parquet(f"{warehouse}/{name}")
    if df.isEmpty():
        _delete(df.sparkSession, f"{warehouse}/{name}/window_seconds={window_seconds}")


def _day(window_start) -> Column:
    return F.date_format(F.timestamp_seconds(window_start), "yyyy-MM-dd")


def _put_days(rows: DataFrame, warehouse: str, name: str) -> None:
    """Replace the sizes and days that rows holds; others stay.

    Rows of a day meet first, so that a day is a file or a few, not one a task; a large day is split.
    """
    dealt = rows.withColumn("day", _day(F.col("window_start"))).hint("rebalance", "window_seconds", "day")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_seconds", "day").parquet(f"{warehouse}/{name}")


def touched_days(spark: SparkSession, warehouse: str, window_seconds: int) -> tuple[list[str], int]:
    """Days of the windows of this size that runs closed since its last refresh brought events to; and the newest run."""
    through = stored(spark, warehouse, "window_refreshes", schemas.REFRESHES).filter(F.col("window_seconds") == window_seconds).agg(F.max("through_run")).first()[0] or 0
    new = [r for r in closed_runs(spark, warehouse) if r > through]
    rows = stored(spark, warehouse, "log_events", f"{schemas.LOG_EVENTS}, run_id bigint, file_bucket int").filter(F.col("run_id").isin(new))
    days = rows.select(_day(window_floor(F.col("epoch"), window_seconds))).distinct().collect()  # a row a day
    return sorted(r[0] for r in days), max(new, default=through)


def refresh_windows(spark: SparkSession, warehouse: str, window_seconds: int = 60, full: bool = False) -> tuple[int, int]:
    """Bring both window tables of one size up to date; rows of each.

    The days that new runs touched are rebuilt from all their events; full rebuilds every
    day. A refresh that fails is taken up by the next one.
    """
    events = table(spark, warehouse, "log_events")
    days, through = touched_days(spark, warehouse, window_seconds)
    if full:
        for name in ("window_features", "window_template_counts"):
            _delete(spark, f"{warehouse}/{name}/window_seconds={window_seconds}")
    else:
        start = window_floor(F.col("epoch"), window_seconds)
        first, last = (F.unix_timestamp(F.lit(d), "yyyy-MM-dd") for d in (min(days, default="1970-01-01"), max(days, default="1970-01-01")))
        # The span prunes files and row groups by their statistics; the days say what is wanted.
        events = events.filter((F.col("epoch") >= first) & (F.col("epoch") < last + 86400 + window_seconds)).filter(_day(start).isin(days))
    if days or full:
        counted = aggregate.counted(events, window_seconds).persist()  # the events are read once for both tables
        try:
            _put_days(aggregate.features_of(counted, window_seconds), warehouse, "window_features")
            _put_days(aggregate.counts_of(counted, window_seconds), warehouse, "window_template_counts")
        finally:
            counted.unpersist()
        mark = spark.createDataFrame([(window_seconds, through, len(days), datetime.now(UTC))], schemas.REFRESHES)
        mark.coalesce(1).write.mode("append").parquet(f"{warehouse}/window_refreshes")
    size = F.col("window_seconds") == window_seconds
    return tuple(stored(spark, warehouse, t, TABLES[t]).filter(size).count() for t in ("window_features", "window_template_counts"))


def store_evaluation(predictions: DataFrame, scored: DataFrame, warehouse: str, window_seconds: int) -> None:
    """Replace the stored scores and predictions of one window size."""
    size = F.lit(window_seconds).alias("window_seconds")
    replace_slice(scored.select(size, *scored.columns), warehouse, "detector_scores", window_seconds)
    replace_slice(predictions.select(size, "window_start", "detector", "variant", "predicted"), warehouse, "window_predictions", window_seconds)


def orphans(events: DataFrame, templates: DataFrame) -> DataFrame:
    """Events whose template isn't in the catalogue; none, if loads were whole."""
    return events.join(templates.select("template_id"), "template_id", "left_anti")
