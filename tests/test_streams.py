"""Lateness accounting, parity with batch, and restarts."""

import math
import os
import time

import pytest
from pyspark.sql import functions as F

from logloom.operators import aggregate
from logloom.operators.parse import good, parse
from logloom.sources import topic
from logloom.streaming import exact, native, replay, scoring, sink

BASE = 1117838400
LINE = "- {epoch} 2005.06.03 {node} 2005-06-03-15.42.50.363779 {node} RAS KERNEL INFO thing"


def lines(spark, offsets, first=1):
    rows = [("f", first + i, LINE.format(epoch=BASE + o, node=f"n{i % 3}")) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "source_file string, line_no bigint, value string")


def replayed(spark, tmp_path, batches, lateness=0, runs=1, drain=True):
    """Rows of the exact stream over one file per batch; several runs resume from the checkpoint."""
    topic, at = str(tmp_path / "topic"), 1
    for step, offsets in enumerate(batches):
        replay.produce(lines(spark, offsets, at).coalesce(1), topic)
        at += len(offsets)
        for name in sorted(os.listdir(topic)):
            path = os.path.join(topic, name)
            if name.endswith(".parquet") and path not in seen_files(tmp_path):
                os.utime(path, (1_700_000_000 + step * 10, 1_700_000_000 + step * 10))
                seen_files(tmp_path).add(path)
        if runs > 1:
            run(spark, tmp_path, topic, lateness)
    if runs == 1:
        run(spark, tmp_path, topic, lateness)
    return spark.read.schema(exact.OUT).parquet(str(tmp_path / "out"))


_SEEN: dict = {}


def seen_files(tmp_path):
    return _SEEN.setdefault(str(tmp_path), set())


def run(spark, tmp_path, topic, lateness):
    events = replay.parsed_events(replay.topic_stream(spark, topic, 1)).withColumn("partition", F.lit(0))
    sink.run_available(exact.exact_stream(events, 60, lateness), str(tmp_path), timeout=120)


def closed(rows):
    return sorted((r["window_start"] - BASE, r["event_count"]) for r in rows.filter("kind = 'window'").collect())


def late(rows):
    return {r["window_start"] - BASE: r["late_events"] for r in exact.late_events(rows).collect()}


def test_closes_on_the_watermark_and_counts_late(spark, tmp_path):
    rows = replayed(spark, tmp_path, [[600, 720], [605, 700], [800], [900]])
    assert closed(rows) == [(600, 1), (660, 1), (720, 1), (780, 1)]
    assert late(rows) == {600: 1}


def test_lateness_rescues(spark, tmp_path):
    rows = replayed(spark, tmp_path, [[600, 660], [610], [720]], lateness=60)
    assert closed(rows) == [(600, 2)]
    assert late(rows) == {}


def test_drain_record_closes_what_is_open(spark, tmp_path):
    replay.produce(lines(spark, [600, 700]), str(tmp_path / "topic"))
    drains = replay.drain_stream(spark, str(tmp_path / "drains"), exact.PARTITIONS)
    events = replay.parsed_events(replay.topic_stream(spark, str(tmp_path / "topic"))).unionByName(drains, allowMissingColumns=True)
    sink.run_available(exact.exact_stream(events, 60), str(tmp_path), timeout=120)
    assert closed(spark.read.schema(exact.OUT).parquet(str(tmp_path / "out"))) == [(600, 1), (660, 1)]


def test_idle_time_closes_what_is_open(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    replay.produce(lines(spark, [600, 601]), topic)
    stream = exact.exact_stream(replay.parsed_events(replay.topic_stream(spark, topic)), 60, idle_ms=1000)
    query = stream.writeStream.foreachBatch(sink.upsert(out)).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            if query.exception() is None and os.path.isdir(out) and closed(spark.read.schema(exact.OUT).parquet(out)):
                break
            time.sleep(1)
    finally:
        query.stop()
    assert closed(spark.read.schema(exact.OUT).parquet(out)) == [(600, 2)]


def test_resumes_from_the_checkpoint(spark, tmp_path):
    rows = replayed(spark, tmp_path, [[600, 601], [602, 650], [665], [725]], runs=4)
    assert closed(rows) == [(600, 4), (660, 1)]
    assert late(rows) == {}


def test_native_update_equals_batch_and_repeated_delivery_changes_nothing(spark, tmp_path):
    source = lines(spark, [i * 13 % 900 for i in range(200)])
    topic = str(tmp_path / "topic")
    replay.produce(source, topic, files=3)
    stream = native.window_stream(replay.parsed_events(replay.topic_stream(spark, topic)), 60)
    query = sink.run_available(stream, str(tmp_path), "update")
    assert sink.progress(query)["rows"] == 200
    got = sink.latest(spark, str(tmp_path / "out"), "window_start")
    batch = aggregate.window_features(good(parse(source)), 60)
    shown = ["window_start", "event_count", "distinct_nodes", "distinct_templates", "error_rate", "is_anomalous"]
    want = sorted(map(tuple, batch.select(shown).collect()))
    assert sorted(map(tuple, got.select(shown).collect())) == want
    again = spark.createDataFrame(got.collect(), got.schema)
    sink.upsert(str(tmp_path / "out"))(again, 0)
    assert sorted(map(tuple, sink.latest(spark, str(tmp_path / "out"), "window_start").select(shown).collect())) == want


def test_progress_counts_records_rejects_windows_and_late_events(spark, tmp_path):
    topic = str(tmp_path / "topic")
    broken = spark.createDataFrame([("key", "broken", "f", 99)], "key string, value string, source_file string, line_no bigint").withColumn("produced_at", F.current_timestamp())
    totals = {}
    for offsets in ([0, 10, 130], [5, 260]):
        replay.records(lines(spark, offsets)).unionByName(broken).coalesce(1).write.mode("append").parquet(topic)
        events = replay.parsed_events(replay.topic_stream(spark, topic)).withColumn("partition", F.lit(0))
        for name, n in sink.progress(sink.run_available(exact.exact_stream(events), str(tmp_path))).items():
            totals[name] = totals.get(name, 0) + n
    assert {n: totals[n] for n in ("records", "rejected", "windows", "late_events")} == {"records": 7, "rejected": 2, "windows": 2, "late_events": 1}


def test_sink_refuses_other_columns(spark, tmp_path):
    batch = spark.createDataFrame([(1, 2)], "a int, b int")
    sink.upsert(str(tmp_path / "out"), columns=("b", "a"))(batch, 0)
    for columns in (("a",), ("a", "b", "c")):
        with pytest.raises(ValueError):
            sink.upsert(str(tmp_path / "out"), columns=columns)(batch, 1)
    assert os.listdir(tmp_path / "out") == ["batch_id=0"]


def test_statistics_without_a_threshold_are_json(spark):
    model = scoring.load_statistics(scoring.export_statistics(aggregate.window_features(good(parse(lines(spark, range(0, 1200, 30)))), 60), aggregate.template_counts(good(parse(lines(spark, range(0, 1200, 30)))), 60)))
    assert model.threshold == math.inf


def test_paced_replay(spark, tmp_path):
    waits = []
    assert replay.paced(lines(spark, [0, 5, 60, 200]), str(tmp_path / "topic"), 10, sleep=waits.append) == 3
    assert waits == [6.0, 12.0]
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 4
    with pytest.raises(ValueError):
        replay.paced(lines(spark, [0]), str(tmp_path / "topic"), -1)


def test_rejects_never_reach_the_topic(spark):
    mixed = lines(spark, [0, 1]).unionByName(spark.createDataFrame([("f", 9, "broken")], "source_file string, line_no bigint, value string"))
    assert replay.records(mixed).count() == 2
    assert tuple(replay.event_time_span(mixed).first()) == (BASE, BASE + 1, 1)


def test_late_side_output_uses_all_tasks(spark, monkeypatch):
    from logloom.plans import queries

    asked = []
    produce = replay.produce
    monkeypatch.setattr(queries, "event_lines", lambda *_: lines(spark, [i * 3600 for i in range(400)]).repartition(3))
    monkeypatch.setattr(replay, "produce", lambda df, *a: (asked.append(df.rdd.getNumPartitions()), produce(df, *a)))
    out = {r["window_start"]: r["late_events"] for r in queries.late_side_output(spark, "").collect()}
    assert sum(out.values()) == 200 and len(asked) == 2 and min(asked) > 1


def test_counters_count_every_batch_of_a_long_run(spark, tmp_path):
    """More batches than Spark's own history keeps, one record each."""
    path = str(tmp_path / "topic")
    replay.produce_partitioned(lines(spark, range(0, 120)), path, 1)
    broken = spark.createDataFrame([(0, "k", "broken", "f", 900 + i) for i in range(3)], "partition int, key string, value string, source_file string, line_no bigint")
    topic.append(broken.withColumn("produced_at", F.current_timestamp()), path)
    stream = topic.topic_stream(spark, path, 1, f"{tmp_path}/progress")
    query = sink.run_until_idle(replay.parsed_events(stream), str(tmp_path))
    total = sink.progress(query)
    assert {k: total[k] for k in ("rows", "batches", "records", "rejected")} == {"rows": 123, "batches": 123, "records": 123, "rejected": 3}
    assert len(query.recentProgress) <= 100
    kept = sink.stored_counts(spark, str(tmp_path))
    assert kept.agg(F.count("batch_id"), F.sum("records"), F.sum("rejected")).first() == (123, 123, 3)


def test_a_batch_holds_late_events_and_values_compactly():
    """Late rows come out a chunk at a time, and the distinct values of a window cost little more than their bytes."""
    import tracemalloc

    import pandas as pd
    import pyarrow as pa

    class Value:
        def __init__(self, at):
            self.at = at

        exists = lambda self: self.at is not None
        get = lambda self: self.at

        def update(self, at):
            self.at = at

    class Map(dict):
        keys = lambda self: iter(())
        containsKey = lambda self, k: False
        updateValue = dict.__setitem__

    def chunk(i):
        n = 10_000
        epoch = [60 * 1000 + 3600 * (j % 2) for j in range(n)]  # half of them late
        names = {"window_start": [e - e % 60 for e in epoch], "epoch": epoch, "node": [f"n{i * n + j}" for j in range(n)]}
        return pd.DataFrame(names).assign(template_id="t", severity="INFO", is_alert=False, drain=False, produced_ms=None)

    own = exact.WindowProcessor(60, 0, None)
    own.clock, own.open, own.values = Value((0, 60 * 1030, exact._NEVER)), Map(), Map()
    start = pa.total_allocated_bytes()
    peak = 0

    def chunks():
        nonlocal peak
        for i in range(40):
            peak = max(peak, tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - start)
            yield chunk(i)

    tracemalloc.start()
    frames = own.handleInputRows((0,), chunks(), None)
    sizes = [(len(f), int((f["kind"] == "late").sum()), f["window_start"].dropna().unique().tolist()) for f in frames]
    tracemalloc.stop()
    assert sum(late for _, late, _ in sizes) == 200_000 and max(n for n, _, _ in sizes) <= 10_000
    assert all(starts == [60_000] for _, n, starts in sizes if n)
    assert peak < 16 << 20
    assert own.open[(63_600,)][0] == 200_000 and own.open[(63_600,)][-3] == 200_000


def test_events_folded_before_the_state_give_the_same_rows():
    """A task's events of a partition and window reach the state as one row; late ones, drains and counts stay what they are."""
    import random

    import pandas as pd
    import pyarrow as pa

    class Value:
        at = None
        exists = lambda self: self.at is not None
        get = lambda self: self.at

        def update(self, at):
            self.at = at

    class Map(dict):
        containsKey = lambda self, k: k in self
        getValue, updateValue, removeKey = dict.__getitem__, dict.__setitem__, dict.pop

    rng = random.Random(3)

    def events(n, drain=False):
        epoch = [rng.randrange(3000) for _ in range(n)]
        rows = [(0, e - e % 60, e, rng.choice("abc") * rng.randint(1, 9), f"t{rng.randrange(4)}", rng.choice(exact.SEVERITIES), rng.random() < 0.1, False, rng.choice([None, e])) for e in epoch]
        return pa.Table.from_pylist([dict(zip(exact._EVENT, r, strict=True)) for r in [*rows, *[(0, None, None, None, None, None, None, True, None)] * drain]], pa.schema(exact._EVENT))

    def run(fold):
        own = exact.WindowProcessor(60, 300, None)
        own.handle, own.clock, own.open, own.values = None, Value(), Map(), Map()
        out = []
        for table in tables:
            batches = [b.to_pandas() for b in (exact._in_runs(iter(table.to_batches(100))) if fold else table.to_batches(100))]
            sizes.append(sum(map(len, batches)))
            frame = pd.concat(list(own.handleInputRows((0,), iter(batches), None)))
            out.append(sorted(map(str, frame.itertuples(index=False))))
        return out, dict(own.open), own.clock.at

    sizes, tables = [], [events(900), events(900), events(0, True), events(50, True)]
    assert run(False) == run(True)
    assert sizes[:3] == [900, 900, 1] and max(sizes[4:6]) <= 50 and sizes[6] == 1


def test_a_stream_is_folded_in_its_tasks(spark, tmp_path):
    replay.drain(spark, str(tmp_path / "drains"), 1)
    replay.produce(lines(spark, range(5)), str(tmp_path / "topic"))
    shown = exact.exact_stream(replay.parsed_events(replay.topic_stream(spark, str(tmp_path / "topic"))), 60)._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in shown
