"""Windows with exact lateness, one watermark per source partition.

A batch is folded whole, then windows that the partition's watermark has passed
are closed. An event is late if its window lies below the end of the highest
closed one; late events come out as rows of their own, so that none is lost
without a trace. Windows still open after an idle time, or when a drain record
arrives, are closed as well; that is for bounded replays only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logloom.functions.time import checked_seconds, window_floor
from logloom.operators.aggregate import error_rate
from logloom.operators.parse import SEVERITIES

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Partitions of a topic unless its source names them.
PARTITIONS = 6
_NEVER = 1 << 62  # the earliest start where no window is open
COUNTS = tuple(f"{s.lower()}_count" for s in SEVERITIES)
OUT = (
    "kind string, partition int, window_start bigint, event_count bigint, distinct_nodes bigint, distinct_templates bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", alert_count bigint, produced_ms bigint, epoch bigint, watermark bigint"
)
_NAMES = [x.split()[0] for x in OUT.split(", ")]
_FACTS = ("event_count", *COUNTS, "alert_count")
_STATE = ", ".join(f"{c} bigint" for c in _FACTS) + ", produced_ms bigint, n_nodes bigint, n_templates bigint, chunks int"
#: Characters of a window's packed values that are held before they are made distinct.
_PENDING = 1 << 16
#: Events of a task that are folded at once, and late ones of a frame.
_RUN_EVENTS, _LATE_ROWS = 1 << 17, 10_000
_RUN = "partition int, window_start bigint, drain boolean, " + ", ".join(f"{c} bigint" for c in _FACTS) + ", latest bigint, produced_ms bigint, nodes string, templates string, epochs binary"
_EVENT = {"partition": pa.int32(), "window_start": pa.int64(), "epoch": pa.int64(), "node": pa.string(), "template_id": pa.string(), "severity": pa.string(), "is_alert": pa.bool_(), "drain": pa.bool_(), "produced_ms": pa.int64()}
_SEPARATOR = "\0"  # in no node of a line that parses


def _packed(values: pa.Array) -> bytes | None:
    return _SEPARATOR.join(sorted(values.to_pylist())).encode() if len(values) else None


def _without(values: pa.Array, packed: bytes | None) -> pa.Array:
    """The values that a chunk doesn't have."""
    if packed is None or not len(values):
        return values
    known = pa.array(bytes(packed).decode().split(_SEPARATOR), pa.string())
    return values.filter(pc.invert(pc.is_in(values, value_set=known)))


def _runs(rows: pa.Table) -> pa.Table:
    """Events folded by partition and window: counts, latest times, distinct values packed, and the events'
    own times (eight bytes each) for the windows that turn out late. A drain record is a row of its own."""
    events = rows.filter(pc.invert(rows["drain"]))
    ones = lambda mask: pc.fill_null(mask, False).cast(pa.int64())
    facts = [pa.array(np.ones(len(events), np.int64)), *(ones(pc.equal(events["severity"], s)) for s in SEVERITIES), ones(events["is_alert"])]
    keys, values = ["partition", "window_start"], {"nodes": "node", "templates": "template_id"}
    columns = {c: events[c] for c in (*keys, "epoch", "produced_ms")} | {k: pc.fill_null(events[c], "") for k, c in values.items()}
    asked = [*((c, "sum") for c in _FACTS), ("epoch", "max"), ("produced_ms", "max"), *((k, "distinct") for k in values), ("epoch", "list")]
    out = pa.table(columns | dict(zip(_FACTS, facts, strict=True))).group_by(keys, use_threads=False).aggregate(asked).combine_chunks()
    times = pa.concat_arrays(out["epoch_list"].chunks) if len(out) else pa.array([], pa.list_(pa.int64()))
    cuts = np.append(0, np.cumsum(pc.list_value_length(times).to_numpy(zero_copy_only=False))).astype(np.int32) * 8
    packed = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(cuts), pa.py_buffer(times.flatten().to_numpy().astype("<i8"))])
    drains = pc.unique(rows.filter(rows["drain"])["partition"])
    n, gone = len(out), len(drains)
    with_drains = lambda column, of: pa.concat_arrays([*column.cast(of).chunks, pa.nulls(gone, of)])
    found = {"partition": pa.concat_arrays([*out["partition"].cast(pa.int32()).chunks, drains]), "window_start": with_drains(out["window_start"], pa.int64())}
    found["drain"] = pa.array(np.arange(n + gone) >= n)
    found |= {c: pc.fill_null(with_drains(out[f"{c}_sum"], pa.int64()), 0) for c in _FACTS}
    found |= {"latest": with_drains(out["epoch_max"], pa.int64()), "produced_ms": with_drains(out["produced_ms_max"], pa.int64())}
    found |= {k: with_drains(pc.binary_join(out[f"{k}_distinct"], _SEPARATOR), pa.string()) for k in values}
    return pa.table(found | {"epochs": pa.concat_arrays([packed, pa.nulls(gone, pa.binary())])})


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The events of a task, folded a run at a time before they go to their partition's task."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= _RUN_EVENTS:
            yield from _runs(pa.Table.from_batches(held)).to_batches()
            held, n = [], 0
    if n:
        yield from _runs(pa.Table.from_batches(held)).to_batches()


class _Values:
    """Distinct strings as an Arrow array, which takes some ten bytes a short value, not a Python string and a
    set's entry. What was added, packed, is made distinct whenever it outgrows what already is."""

    def __init__(self):
        self.once, self.more, self.pending = pa.array([], pa.string()), [], 0

    def add(self, packed: list[str]) -> None:
        self.more += packed
        self.pending += sum(map(len, packed))
        if self.pending > max(_PENDING, self.once.nbytes):
            self.distinct()

    def distinct(self) -> pa.Array:
        if self.more:
            values = pc.split_pattern(pa.array(self.more, pa.string()), _SEPARATOR).flatten()
            self.once, self.more, self.pending = pc.unique(pa.concat_arrays([self.once, values])), [], 0
        return self.once


class _Window:
    """What a batch adds to a window."""

    def __init__(self):
        self.facts, self.produced_ms, self.nodes, self.templates = np.zeros(len(_FACTS), np.int64), -1, _Values(), _Values()

    def add(self, facts: np.ndarray, produced_ms: int, nodes: list[str], templates: list[str]) -> None:
        self.facts = self.facts + facts
        self.produced_ms = max(self.produced_ms, produced_ms)
        self.nodes.add(nodes)
        self.templates.add(templates)


def _folded(runs: pd.DataFrame) -> Iterator[tuple[int, tuple[np.ndarray, int, list[str], list[str]]]]:
    """Each window of a chunk of runs with what _Window.add takes."""
    if len(runs):
        by = runs.groupby(runs["window_start"].astype(np.int64))
        facts, produced = by[list(_FACTS)].sum(), by["produced_ms"].max().fillna(-1)
        for start, own, at, nodes, templates in zip(facts.index, facts.to_numpy(np.int64), produced, by["nodes"].agg(list), by["templates"].agg(list), strict=True):
            yield int(start), (own, int(at), nodes, templates)


class WindowProcessor(StatefulProcessor):
    """State of a partition: its clock, its open windows' counts, and their distinct values.

    Values are kept in chunks, one for each batch that brought the window new ones, and a
    chunk is never written again: what a batch writes follows its own new values, not what
    the window has gathered. A window that opens and closes in one batch leaves no state.
    Rows are runs (_RUN); events that come as they are, are folded here.
    """

    def __init__(self, window_seconds: int, lateness: int, idle_ms: int | None):
        self.window_seconds, self.lateness, self.idle_ms = window_seconds, lateness, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "latest bigint, closed_through bigint, earliest bigint")
        self.open = handle.getMapState("open", "window_start bigint", _STATE)
        self.values = handle.getMapState("values", "window_start bigint, chunk int", "nodes binary, templates binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest, closed, earliest = self.clock.get() if self.clock.exists() else (-1, 0, _NEVER)
        late, new, drain = [], {}, False
        for batch in rows:
            if "nodes" not in batch.columns:
                own = {c: batch[c] if c in batch.columns else key[0] for c in _EVENT}
                batch = _runs(pa.Table.from_pandas(pd.DataFrame(own), pa.schema(_EVENT), preserve_index=False)).to_pandas()
            ends = batch["drain"].astype(bool)
            drain = drain or bool(ends.any())
            runs = batch[~ends]
            if not len(runs):
                continue
            latest = max(latest, int(runs["latest"].max()))
            behind = runs["window_start"] < closed
            if behind.any():
                late.append(b"".join(runs.loc[behind, "epochs"]))
            for start, added in _folded(runs[~behind]):
                new.setdefault(start, _Window()).add(*added)
        earliest = min([earliest, *new])
        mark, out = latest - self.lateness, []
        # Open windows are only listed when one of them is due.
        if drain or earliest + self.window_seconds <= mark:
            starts = {k[0] for k in self.open.keys()} | set(new)
            due = sorted(s for s in starts if drain or s + self.window_seconds <= mark)
            if due:
                closed = max(closed, due[-1] + self.window_seconds)
            out = self._close(due, new)
            earliest = min(starts.difference(due), default=_NEVER)
        for start, window in new.items():
            self._keep(start, window)
        self.clock.update((latest, closed, earliest))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._frame(key, pd.DataFrame(out, columns=_NAMES))
        # Late events wait for the batch's mark as eight bytes each, and become rows a chunk at a time.
        for packed in late:
            times = np.frombuffer(packed, "<i8")
            for epochs in (times[i : i + _LATE_ROWS] for i in range(0, len(times), _LATE_ROWS)):
                yield self._frame(key, pd.DataFrame({"kind": "late", "window_start": epochs - epochs % self.window_seconds, "epoch": epochs, "watermark": mark}))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        latest, closed, _ = self.clock.get() if self.clock.exists() else (-1, 0, _NEVER)
        due = sorted(k[0] for k in self.open.keys())
        if due:
            self.clock.update((latest, max(closed, due[-1] + self.window_seconds), _NEVER))
        yield self._frame(key, pd.DataFrame(self._close(due, {}), columns=_NAMES))

    def close(self) -> None:
        pass

    def _known(self, start: int) -> tuple:
        """The state of a window; that of an unknown one has no chunks."""
        return self.open.getValue((start,)) if self.open.containsKey((start,)) else (*[0] * len(_FACTS), -1, 0, 0, 0)

    def _unseen(self, start: int, window: _Window, chunks: int) -> tuple[pa.Array, pa.Array]:
        """The window's nodes and templates that no chunk has."""
        nodes, templates = window.nodes.distinct(), window.templates.distinct()
        for chunk in range(chunks):
            a, b = self.values.getValue((start, chunk))
            nodes, templates = _without(nodes, a), _without(templates, b)
        return nodes, templates

    def _keep(self, start: int, window: _Window) -> None:
        """Add what the batch brought to the state of a window that stays open."""
        *facts, produced, n_nodes, n_templates, chunks = self._known(start)
        nodes, templates = self._unseen(start, window, chunks)
        if len(nodes) or len(templates):
            self.values.updateValue((start, chunks), (_packed(nodes), _packed(templates)))
            chunks += 1
        counts = [int(a + b) for a, b in zip(facts, window.facts, strict=True)]
        self.open.updateValue((start,), (*counts, max(produced, window.produced_ms), n_nodes + len(nodes), n_templates + len(templates), chunks))

    def _close(self, due: list[int], new: dict[int, _Window]) -> list[dict]:
        """Rows of the due windows, which leave the state and new."""
        out = []
        for start in due:
            *facts, produced, n_nodes, n_templates, chunks = self._known(start)
            # Chunks are only read where the closing batch brings something itself.
            if window := new.pop(start, None):
                nodes, templates = self._unseen(start, window, chunks)
                facts = [int(a + b) for a, b in zip(facts, window.facts, strict=True)]
                produced, n_nodes, n_templates = max(produced, window.produced_ms), n_nodes + len(nodes), n_templates + len(templates)
            for chunk in range(chunks):
                self.values.removeKey((start, chunk))
            if chunks:
                self.open.removeKey((start,))
            row = dict(zip(_FACTS, facts, strict=True))
            out.append(row | {"kind": "window", "window_start": start, "distinct_nodes": n_nodes, "distinct_templates": n_templates, "produced_ms": produced if produced >= 0 else None})
        return out

    def _frame(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        frame = rows.reindex(columns=_NAMES).assign(partition=key[0]).reset_index(drop=True)
        return frame.astype({n: "Int64" for n in _NAMES if n not in ("kind", "partition")} | {"partition": "Int32"})


def exact_stream(events: DataFrame, window_seconds: int = 60, lateness_seconds: int = 0, partitions: int = PARTITIONS, idle_ms: int | None = None) -> DataFrame:
    """Rows of kind 'window' and 'late' out of a stream of events.

    A window's events share a partition, as the topic's key makes them. events
    may have the columns partition, drain and produced_at; a record with a true drain closes
    its partition's windows and carries nothing else. Both kinds are counted for the
    run's progress.
    """
    if lateness_seconds < 0:
        raise ValueError(f"allowed_lateness must not be negative, got {lateness_seconds}")
    start = window_floor(F.col("epoch"), checked_seconds(window_seconds))
    rows = events.withColumn("window_start", start)
    rows = rows.withColumn("drain", F.coalesce("drain", F.lit(False)) if "drain" in events.columns else F.lit(False))
    own = F.pmod(F.xxhash64("window_start"), F.lit(partitions)).cast("int")
    rows = rows.withColumn("partition", F.coalesce("partition", own) if "partition" in events.columns else own)
    produced = F.unix_millis("produced_at") if "produced_at" in events.columns else F.lit(None).cast("long")
    rows = rows.select("partition", "window_start", "epoch", "node", "template_id", "severity", "is_alert", "drain", produced.alias("produced_ms"))
    processor = WindowProcessor(window_seconds, lateness_seconds, idle_ms)
    mode = "none" if idle_ms is None else "processingTime"
    out = rows.mapInArrow(_in_runs, _RUN).groupBy("partition").transformWithStateInPandas(processor, OUT, "append", mode)
    return out.observe("lateness", F.count_if(F.col("kind") == "window").alias("windows"), F.count_if(F.col("kind") == "late").alias("late_events"))


def closed_windows(rows: DataFrame, window_seconds: int) -> DataFrame:
    """The window rows in the columns of the batch windows, with late_events = 0."""
    out = rows.filter("kind = 'window'").withColumn("error_rate", error_rate())
    return out.select(
        F.lit(window_seconds).alias("window_seconds"), "window_start", "event_count", "distinct_nodes", "distinct_templates",
        *COUNTS, "error_rate", "alert_count", (F.col("alert_count") > 0).alias("is_anomalous"), F.lit(0).cast("long").alias("late_events"),
        F.timestamp_millis("produced_ms").alias("produced_at"),
    )


def late_events(rows: DataFrame) -> DataFrame:
    """Late events per window that they belonged to."""
    return rows.filter("kind = 'late'").groupBy("window_start").agg(F.count(F.lit(1)).alias("late_events"))
