"""Idempotent keyed sink for micro-batches, and bounded runs of a stream."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from threading import Event
from uuid import uuid4

from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logloom.sources import topic
from logloom.sources.schemas import require
from logloom.sources.scratch import checkpoint_folder


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the shared one."""
    return f"{checkpoint_folder(spark)}/run-{uuid4().hex}"


def upsert(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, columns: tuple[str, ...] | dict[str, str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: a batch replaces its own folder, so a repeated delivery changes nothing.

    columns: those that a batch must have, and no others; any if empty. A dict gives their types too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch)
        if columns:
            require(rows, columns, exact=True)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


_FOLDED = "_folded"


def _manifest(path: str) -> dict:
    """Up to which batch the sink was folded, and the folder that holds each day."""
    store, at = topic.file_store(path)
    name = f"{at}/{_FOLDED}/manifest.json"
    if store.get_file_info(name).type != FileType.File:
        return {"through": -1, "days": {}, "replaced": []}
    with store.open_input_stream(name) as file:
        return json.loads(file.read())


def _batches(path: str) -> list[int]:
    store, at = topic.file_store(path)
    found = store.get_file_info(FileSelector(at, allow_not_found=True))
    return sorted(int(f.base_name.removeprefix("batch_id=")) for f in found if f.base_name.startswith("batch_id="))


def _versions(spark: SparkSession, path: str, schema: str | None, days: list[str] | None = None) -> DataFrame | None:
    """Rows with their batch_id: of folded days (some, or all) and of the batches since."""
    known, parts = _manifest(path), []
    reader = lambda: spark.read if schema is None else spark.read.schema(f"{schema}, batch_id int")
    folders = [f"{path}/{_FOLDED}/{at}/folded_day={day}" for day, at in known["days"].items() if days is None or day in days]
    if folders:
        parts.append(reader().parquet(*folders))
    if since := [n for n in _batches(path) if n > known["through"]]:
        parts.append(reader().option("basePath", path).parquet(*(f"{path}/batch_id={n}" for n in since)))
    return reduce(lambda a, b: a.unionByName(b.select(*a.columns)), parts) if parts else None


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """Of each key the rows of its last batch."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("batch_id").alias("_batch"))
    return rows.join(last, (rows[key] == last["_key"]) & (rows["batch_id"] == last["_batch"])).drop("_key", "_batch")


def latest(spark: SparkSession, path: str, key: str, schema: str | None = None) -> DataFrame:
    """The newest row of each key, over the folded days and the batches since."""
    rows = _versions(spark, path, schema)
    if rows is None:
        if schema is None:
            raise FileNotFoundError(f"nothing was written to {path}")
        return spark.createDataFrame([], schema)
    return _newest(rows, key).drop("batch_id")


def fold(spark: SparkSession, path: str, key: str, day: Column, keep: int = 1) -> int:
    """Fold all but the last `keep` batches into one folder a day; returns the last folded batch.

    day: a date or string that follows from the key. Only the days that the batches touch
    are written anew, beside the old ones; a manifest that is put in place at once says which
    folders hold, so a fold that fails changes nothing. A folded batch that is delivered
    again is not read. What a fold replaced is deleted by the next one, and readers that began
    before have until then. Folds of one sink follow each other.
    """
    known = _manifest(path)
    closed = [n for n in _batches(path) if n > known["through"]][: -keep or None]
    if not closed:
        return known["through"]
    store, at = topic.file_store(path)
    new = spark.read.option("basePath", path).parquet(*(f"{path}/batch_id={n}" for n in closed)).withColumn("folded_day", day.cast("string"))
    touched = [r[0] for r in new.select("folded_day").distinct().collect()]  # days of the batches
    folders = [f"{path}/{_FOLDED}/{known['days'][d]}/folded_day={d}" for d in touched if d in known["days"]]
    if folders:
        new = new.unionByName(spark.read.parquet(*folders).withColumn("folded_day", day.cast("string")).select(*new.columns))
    name = f"days-{uuid4().hex}"
    _newest(new, key).repartition("folded_day").write.partitionBy("folded_day").parquet(f"{path}/{_FOLDED}/{name}")
    replaced = [f"{known['days'][d]}/folded_day={d}" for d in touched if d in known["days"]]
    state = {"through": closed[-1], "days": known["days"] | dict.fromkeys(touched, name), "replaced": replaced}
    with store.open_output_stream(f"{at}/{_FOLDED}/.manifest") as file:
        file.write(json.dumps(state).encode())
    store.move(f"{at}/{_FOLDED}/.manifest", f"{at}/{_FOLDED}/manifest.json")
    for n in _batches(path):
        if n <= known["through"]:
            store.delete_dir(f"{at}/batch_id={n}")
    for gone in known["replaced"]:
        store.delete_dir(f"{at}/{_FOLDED}/{gone}")
    return closed[-1]


class Counters(StreamingQueryListener):
    """Sums over every batch of one query, however long it runs; with a folder, each batch's
    own counts are kept there too, a file a batch, which a repeated batch replaces."""

    def __init__(self, name: str, folder: str | None = None):
        self.name, self.folder, self.run_id = name, folder, None
        self.totals: dict[str, float] = {"rows": 0, "batches": 0, "milliseconds": 0}
        self.ended = Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        step = event.progress
        if step.name != self.name:
            return
        found = {k: v or 0 for m in step.observedMetrics.values() for k, v in m.asDict().items()}
        if not found and not step.numInputRows:
            return  # nothing ran
        own = {"rows": step.numInputRows, "batches": int(step.numInputRows > 0), "milliseconds": step.durationMs.get("triggerExecution", 0) if step.numInputRows else 0}
        for k, v in (own | found).items():
            self.totals[k] = self.totals.get(k, 0) + v
        if self.folder:
            store, at = topic.file_store(self.folder)
            store.create_dir(at, recursive=True)
            with store.open_output_stream(f"{at}/batch-{step.batchId:012d}.json") as file:
                file.write(json.dumps({"batch_id": step.batchId, "timestamp": step.timestamp} | own | found).encode())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()

    def summary(self) -> dict[str, float]:
        ms = self.totals["milliseconds"]
        return {k: v for k, v in self.totals.items() if k != "milliseconds"} | {"rows_per_second": self.totals["rows"] / ms * 1000 if ms else 0.0}


#: Counters of queries that ran here, by run.
_COUNTERS: dict[str, Counters] = {}
#: Seconds in which the last events of an ended query must have come in.
_LAST_EVENTS = 30


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """A row for each batch that any run of the stream at this path went through."""
    return spark.read.schema("batch_id bigint, timestamp timestamp, rows bigint, batches bigint, milliseconds bigint, records bigint, rejected bigint, windows bigint, late_events bigint").json(f"{path}/counts")


def _started(writer, spark: SparkSession, path: str):
    """The query, and its counters, which listen from its start on."""
    counters = Counters(f"logloom-{uuid4().hex}", f"{path}/counts")
    spark.streams.addListener(counters)
    try:
        query = writer.queryName(counters.name).start()
    except Exception:
        spark.streams.removeListener(counters)
        raise
    _COUNTERS[str(query.runId)] = counters
    return query, counters


def _writer(stream: DataFrame, path: str, mode: str, prepare: Callable[[DataFrame], DataFrame], columns: tuple[str, ...] | dict[str, str]):
    return stream.writeStream.outputMode(mode).foreachBatch(upsert(f"{path}/out", prepare, columns)).option("checkpointLocation", f"{path}/checkpoint")


def run_available(
    stream: DataFrame, path: str, mode: str = "append", prepare: Callable[[DataFrame], DataFrame] = lambda df: df, timeout: int = 1800, columns: tuple[str, ...] | dict[str, str] = (), max_runtime: int | None = None
):
    """Run a stream over what is there, into path/out with its checkpoint beside; returns the query.

    A run is stopped in good order after max_runtime seconds: what its batches wrote stays,
    and the next run takes up the rest. Without it, a run past the timeout is an error.
    """
    spark = stream.sparkSession
    query, counters = _started(_writer(stream, path, mode, prepare, columns).trigger(availableNow=True), spark, path)
    try:
        if not query.awaitTermination(timeout if max_runtime is None else max_runtime):
            query.stop()
            if max_runtime is None:
                raise TimeoutError(f"the stream took more than {timeout} s")
        counters.ended.wait(_LAST_EVENTS)
    finally:
        spark.streams.removeListener(counters)
    return query


def run_until_idle(
    stream: DataFrame, path: str, mode: str = "append", prepare: Callable[[DataFrame], DataFrame] = lambda df: df, columns: tuple[str, ...] | dict[str, str] = (), idle_seconds: float = 0, max_runtime: float | None = None
):
    """Run batch by batch, as a source with a limit admits them, until nothing has come for
    idle_seconds or max_runtime is over; returns the stopped query."""
    spark = stream.sparkSession
    query, counters = _started(_writer(stream, path, mode, prepare, columns).trigger(processingTime="0 seconds"), spark, path)
    began = last = time.monotonic()
    seen, patient = -1, idle_seconds > 0 or max_runtime is not None
    try:
        while True:
            query.awaitTermination(0.2) if patient else query.processAllAvailable()
            if error := query.exception():
                raise error
            now = time.monotonic()
            if counters.totals["rows"] != seen or query.status["isDataAvailable"]:
                seen, last = counters.totals["rows"], now
            over = max_runtime is not None and now - began >= max_runtime
            if over or not patient or 0 < idle_seconds <= now - last:
                break
    finally:
        query.stop()
        counters.ended.wait(_LAST_EVENTS)
        spark.streams.removeListener(counters)
    return query


def progress(query) -> dict[str, float]:
    """Rows read, batches and rows a second of a finished run, and the sums of what it observed, over all its batches."""
    return _COUNTERS[str(query.runId)].summary()
