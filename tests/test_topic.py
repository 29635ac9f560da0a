"""Partitioned topics, clocks by partition, state by chunk, the folded sink, and a look into state."""

import os
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streams import BASE, lines

from logloom.sources import topic
from logloom.streaming import exact, inspect, measure, replay, sink

RECORDS = "partition int, key string, value string, source_file string, line_no bigint"


def records(spark, rows):
    return spark.createDataFrame([(p, "k", f"v{n}", "f", n) for p, n in rows], RECORDS).withColumn("produced_at", F.current_timestamp())


def stored(spark, path):
    return sorted((r["partition"], r["offset"], r["line_no"]) for r in topic.read_topic(spark, path).collect())


def test_offsets_are_dense_and_follow_the_lines(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(1)
    first = [(rng.choice([0, 0, 0, 2]), n) for n in range(200)]
    second = [(rng.choice([0, 1]), n) for n in range(200, 300)]
    rng.shuffle(first)
    topic.append(records(spark, first).repartition(5), path, files=7)
    assert topic.append(records(spark, second), path) == {p: n for p, n in Counter(p for p, _ in first + second).items()}
    want = []
    for p in (0, 1, 2):
        own = sorted(n for q, n in first if q == p) + sorted(n for q, n in second if q == p)
        want += [(p, i, n) for i, n in enumerate(own)]
    assert stored(spark, path) == want


def test_a_hot_partition_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path)
    topic.append(records(spark, [(0, n) for n in range(1000)]), path, files=3)
    found = topic.segments(path)
    plan = topic.planned(found, {0: 130}, {0: 905}, 100)
    assert sum(r.rows for r in plan) == 775 and max(r.rows for r in plan) <= 100
    got = [(o, v) for r in plan for b in topic._rows(r) for o, v in zip(b["offset"].to_pylist(), b["line_no"].to_pylist(), strict=True)]
    assert sorted(got) == [(n, n) for n in range(130, 905)]


def test_what_is_not_committed_is_not_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    topic.append(records(spark, [(0, 1)]), path)
    monkeypatch.setattr(topic, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        topic.append(records(spark, [(0, 2), (1, 3)]), path)
    monkeypatch.undo()
    assert stored(spark, path) == [(0, 0, 1)]
    topic.append(records(spark, [(0, 2), (1, 3)]), path)
    assert stored(spark, path) == [(0, 0, 1), (0, 1, 2), (1, 0, 3)]


def test_records_need_a_partition(spark, tmp_path):
    with pytest.raises(ValueError):
        topic.append(records(spark, [(None, 1)]), str(tmp_path))
    assert topic.append(records(spark, []), str(tmp_path)) == {}
    assert stored(spark, str(tmp_path)) == []


def test_admission_shares_by_what_waits():
    assert topic.admitted({}, {0: 10, 1: 90}, None) == {0: 10, 1: 90}
    assert topic.admitted({}, {0: 10, 1: 90}, 20) == {0: 2, 1: 18}
    assert topic.admitted({0: 10, 1: 18}, {0: 10, 1: 90, 2: 1}, 20) == {0: 10, 1: 37, 2: 1}
    assert topic.admitted({0: 10}, {0: 10}, 5) == {0: 10}
    at, last, steps = {}, {0: 7, 3: 1000, 5: 1}, 0
    while at != last:
        at, steps = topic.admitted(at, last, 64), steps + 1
    assert 16 <= steps <= 18


def test_a_restart_goes_on_where_the_checkpoint_ends(spark, tmp_path):
    path, sizes = f"{tmp_path}/topic", []

    def run(most):
        stream = topic.topic_stream(spark, path, most, f"{tmp_path}/progress")
        query = sink.run_until_idle(stream, str(tmp_path))
        out = spark.read.schema(f"{topic.SCHEMA}, batch_id int").parquet(f"{tmp_path}/out").groupBy("batch_id").count().orderBy("batch_id").collect()
        sizes[:] = [r["count"] for r in out]
        return sink.progress(query)["rows"]

    topic.append(records(spark, [(n % 2, n) for n in range(40)]), path)
    assert run(15) == 40 and sum(sizes) == 40 and max(sizes) <= 15
    topic.append(records(spark, [(n % 3, n) for n in range(40, 100)]), path)
    old = len(sizes)
    assert run(7) == 60 and max(sizes[old:]) <= 8  # a smaller limit than before, no record twice
    out = spark.read.schema(topic.SCHEMA).parquet(f"{tmp_path}/out")
    assert out.count() == out.select("partition", "offset").distinct().count() == 100


def test_named_partitions_alone(spark, tmp_path):
    topic.append(records(spark, [(n % 3, n) for n in range(30)]), f"{tmp_path}/topic")
    sink.run_until_idle(topic.topic_stream(spark, f"{tmp_path}/topic", partitions=(0, 2)), str(tmp_path))
    assert {r[0] for r in spark.read.schema(topic.SCHEMA).parquet(f"{tmp_path}/out").select("partition").distinct().collect()} == {0, 2}


def clocked(spark, tmp_path, steps, **how):
    """Rows of the exact stream over [(partition, offset in seconds), ...] a run."""
    at = 1
    for step in steps:
        where = {at + i: p for i, (p, _) in enumerate(step)}
        partition = F.element_at(F.create_map(*(F.lit(x) for kv in where.items() for x in kv)), F.col("line_no").cast("int")).cast("int")
        replay.produce_partitioned(lines(spark, [o for _, o in step], at), f"{tmp_path}/topic", 2, 60, partition)
        at += len(step)
        sink.run_until_idle(exact.exact_stream(replay.parsed_events(topic.topic_stream(spark, f"{tmp_path}/topic")), 60, **how), str(tmp_path))
    return spark.read.schema(exact.OUT).parquet(f"{tmp_path}/out")


DAY = 86400


def test_each_partition_closes_by_its_own_clock(spark, tmp_path):
    steps = [[(0, 600), (1, DAY + 600), (0, 720), (1, DAY + 660)], [(0, 605), (0, 700), (1, DAY + 661), (1, DAY + 601)], [(0, 800), (1, DAY + 800)]]
    rows = clocked(spark, tmp_path, steps)
    closed = sorted((r["partition"], r["window_start"] - BASE, r["event_count"]) for r in rows.filter("kind = 'window'").collect())
    late = sorted((r["partition"], r["window_start"] - BASE, r["epoch"] - BASE, r["watermark"] - BASE) for r in rows.filter("kind = 'late'").collect())
    # One clock for both would have called all of partition 0 late.
    assert closed == [(0, 600, 1), (0, 660, 1), (0, 720, 1), (1, DAY + 600, 1), (1, DAY + 660, 2)]
    assert late == [(0, 600, 605, 720), (1, DAY + 600, DAY + 601, DAY + 661)]


def test_state_reader_shows_what_a_drain_would_emit(spark, tmp_path):
    steps = [[(0, 600), (0, 720), (1, 30), (0, 725)], [(0, 721), (0, 790), (1, 31), (1, 95)]]
    clocked(spark, tmp_path, steps, lateness_seconds=60)
    checkpoint = f"{tmp_path}/checkpoint"
    assert sorted(tuple(c - BASE if i else c for i, c in enumerate(r)) for r in inspect.clocks(spark, checkpoint, 60).collect()) == [(0, 790, 730, 660), (1, 95, 35, -BASE)]
    shown = ["partition", "window_start", "event_count", "distinct_nodes", "distinct_templates", "info_count"]
    left = sorted(map(tuple, inspect.open_windows(spark, checkpoint).select(*shown).collect()))
    query = exact.exact_stream(replay.parsed_events(topic.topic_stream(spark, f"{tmp_path}/topic")), 60, 60, idle_ms=500)
    before = spark.read.schema(exact.OUT).parquet(f"{tmp_path}/out").filter("kind = 'window'").count()
    # The same topic from its start in a stream that drains: its last windows are those left open.
    sink.run_until_idle(query, f"{tmp_path}/again", idle_seconds=8)
    drained = spark.read.schema(exact.OUT).parquet(f"{tmp_path}/again/out").filter("kind = 'window'").select(*shown)
    assert drained.count() == before + len(left)
    assert set(left) <= set(map(tuple, drained.collect())) and [w[1] - BASE for w in left] == [720, 780, 0, 60]


class State:
    """A map state in memory that counts the bytes that are put into it."""

    def __init__(self):
        self.rows, self.written = {}, 0

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = value
        self.written += sum(len(v) if isinstance(v, bytes) else 8 for v in (*key, *value) if v is not None)

    def removeKey(self, key):
        del self.rows[key]

    def keys(self):
        return iter(self.rows)


class Clock(State):
    def exists(self):
        return () in self.rows

    def get(self):
        return self.rows[()]

    def update(self, value):
        self.updateValue((), value)


def processor(lateness=0):
    p = exact.WindowProcessor(60, lateness, None)
    p.clock, p.open, p.values = Clock(), State(), State()
    return p


def batch(events):
    return pd.DataFrame([(e // 60 * 60, e, n, t, "INFO", False, False, None) for e, n, t in events], columns=["window_start", "epoch", "node", "template_id", "severity", "is_alert", "drain", "produced_ms"]).astype({"produced_ms": "Int64"})


def test_state_equals_sets_over_random_batches():
    for seed in range(6):
        rng, p = random.Random(seed), processor(lateness=120)
        sets, closed, latest, through = {}, {}, -1, 0
        for step in range(40):
            events = [(1000 + step * 20 + rng.randrange(-150, 60), f"n{rng.randrange(30)}", f"t{rng.randrange(5)}") for _ in range(rng.randrange(1, 30))]
            fine = [e for e in events if e[0] // 60 * 60 >= through]
            for e, n, t in fine:
                sets.setdefault(e // 60 * 60, []).append((n, t))
            latest = max(latest, *(e for e, _, _ in events))
            out = pd.concat(list(p.handleInputRows((0,), iter([batch(events)]), None)))
            due = sorted(w for w in sets if w + 60 <= latest - 120)
            through = max(through, due[-1] + 60) if due else through
            closed = {w: (len(sets[w]), len({n for n, _ in sets[w]}), len({t for _, t in sets.pop(w)})) for w in due}
            windows = out[out.kind == "window"]
            assert {r.window_start: (r.event_count, r.distinct_nodes, r.distinct_templates) for r in windows.itertuples()} == closed
            assert (out.kind == "late").sum() == len(events) - len(fine)
        assert {k[0] for k in p.values.rows} == {k[0] for k in p.open.rows} == set(sets)  # closed windows leave nothing


def test_a_batch_writes_its_new_values_alone():
    p = processor(lateness=10_000)
    list(p.handleInputRows((0,), iter([batch([(600, f"node-{n:06d}", "t") for n in range(20_000)])]), None))
    assert p.values.written > 200_000
    for events, most in (([(601, "node-000007", "t")] * 50, 0), ([(602, "fresh", "t")], 60), ([(603, f"new-{n}", "u") for n in range(100)], 1500)):
        before = p.values.written
        list(p.handleInputRows((0,), iter([batch(events)]), None))
        assert p.values.written - before <= most
    assert p.open.rows[(600,)][-3:] == (20_101, 2, 3)


def test_folded_sink_follows_live_keys(spark, tmp_path):
    path, rng, want = f"{tmp_path}/out", random.Random(4), {}
    schema = "window_start bigint, n bigint"
    day = F.from_unixtime("window_start", "yyyy-MM-dd")
    write = sink.upsert(path)

    def deliver(number, rows):
        write(spark.createDataFrame(rows, schema), number)

    def shown():
        return {r["window_start"]: r["n"] for r in sink.latest(spark, path, "window_start", schema).collect()}

    sent = {}
    for number in range(12):
        sent[number] = [(w * 3600, number * 100 + w) for w in rng.sample(range(72), 10)]
        deliver(number, sent[number])
        want |= dict(sent[number])
        if number in (4, 5, 10):
            assert sink.fold(spark, path, "window_start", day) == number - 1
        assert shown() == want
    assert sink.fold(spark, path, "window_start", day, keep=0) == 11
    assert shown() == want and spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*(f"{path}/_folded/{at}/folded_day={d}" for d, at in sink._manifest(path)["days"].items())).count() == len(want)
    deliver(3, [(w * 3600, -1) for w in range(72)])  # a folded batch, delivered again with other rows even
    assert shown() == want
    assert sink.fold(spark, path, "window_start", day) == 11
    deliver(12, [(0, 7)])
    assert shown() == want | {0: 7}


def test_a_fold_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/out"
    for number in range(3):
        sink.upsert(path)(spark.createDataFrame([(1, number), (number + 5, number)], "k bigint, n bigint"), number)
    want = sorted(map(tuple, sink.latest(spark, path, "k").collect()))
    monkeypatch.setattr(sink.json, "dumps", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sink.fold(spark, path, "k", F.lit("d"))
    monkeypatch.undo()
    assert sorted(map(tuple, sink.latest(spark, path, "k").collect())) == want
    assert sink.fold(spark, path, "k", F.lit("d")) == 1
    assert sorted(map(tuple, sink.latest(spark, path, "k").collect())) == want
    assert os.path.isdir(f"{path}/batch_id=2")


def test_members_share_a_topic(spark, tmp_path):
    source = lines(spark, [i * 7 % 3000 for i in range(400)])
    out = measure.members_runs(spark, source, members=2, runs=2, partitions=4)
    assert [r["members"] for r in out["runs"]] == [2, 2] and all(r["records"] == 400 for r in out["runs"])
    assert out["windows"] == len({i * 7 % 3000 // 60 for i in range(400)}) and out["late_events"] == 0
    assert out["median_events_per_second"] > 0


def test_an_append_makes_its_records_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = spark.range(1000).selectExpr("cast(id % 2 AS int) AS partition", "'k' AS key", "'v' AS value", "'f' AS source_file", "id AS line_no", "current_timestamp() AS produced_at")
    assert topic.append(rows.mapInArrow(counted, rows.schema), f"{tmp_path}/topic") == {0: 500, 1: 500}
    assert made.value == 1000 and not list(tmp_path.glob("topic/staged-*"))
    assert topic.read_topic(spark, f"{tmp_path}/topic").count() == 1000
