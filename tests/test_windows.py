"""Window aggregates, splits, ranks and metrics against small references."""

import math
import random

import pytest
from pyspark.sql import functions as F

from logloom.functions.ranking import by_day, by_value, running
from logloom.functions.time import window_floor
from logloom.operators import aggregate, compare, evaluate, metrics
from logloom.operators.detect import ZScore
from logloom.operators.features import build_matrix, split_parts, top_templates
from logloom.operators.parse import good, parse

BASE = 1117838520


def log(spark, rows):
    """Events out of (offset, label, node, severity, message)."""
    day = "2005.06.03 {n} 2005-06-03-15.42.50.363779 {n} RAS KERNEL"
    lines = [("f", i, f"{label} {BASE + at} {day.format(n=node)} {severity} {message}") for i, (at, label, node, severity, message) in enumerate(rows, 1)]
    return good(parse(spark.createDataFrame(lines, "source_file string, line_no bigint, value string")))


ROWS = [
    (0, "-", "a", "INFO", "cache error"), (1, "-", "a", "INFO", "cache error"), (2, "-", "b", "WARNING", "ddr"), (3, "-", "b", "ERROR", "sym 2"),
    (60, "-", "a", "INFO", "cache error"), (61, "X", "a", "FATAL", "tlb"), (62, "X", "c", "FATAL", "tlb"), (70, "-", "c", "SEVERE", "panic"), (75, "-", "c", "FATAL", "storage"),
    (120, "-", "NULL", "FAILURE", "exit 13"), (300, "-", "a", "INFO", "core.1"), (301, "-", "a", "INFO", "core.9"),
]


def test_windows(spark):
    rows = {r["window_start"] - BASE: r for r in aggregate.window_features(log(spark, ROWS), 60).collect()}
    assert sorted(rows) == [0, 60, 120, 300]
    facts = {k: (r["event_count"], r["distinct_nodes"], r["distinct_templates"], r["error_rate"], r["alert_count"], r["is_anomalous"]) for k, r in rows.items()}
    assert facts == {0: (4, 2, 3, 0.25, 0, False), 60: (5, 2, 4, 0.8, 2, True), 120: (1, 1, 1, 1.0, 0, False), 300: (2, 1, 1, 0.0, 0, False)}
    assert sorted(r["event_count"] for r in aggregate.window_features(log(spark, ROWS), 300).collect()) == [2, 10]


def test_template_counts_add_up(spark):
    events = log(spark, ROWS)
    counts = aggregate.template_counts(events, 60)
    assert counts.agg(F.sum("event_count")).first()[0] == len(ROWS)
    assert sorted(r["event_count"] for r in counts.filter(F.col("window_start") == BASE).collect()) == [1, 1, 2]


def test_window_size_must_be_positive():
    with pytest.raises(ValueError):
        window_floor(F.lit(1), 0)


def test_running_equals_a_global_window(spark):
    random.seed(5)
    data = [(random.randint(0, 10**6), random.randint(0, 3), i) for i in range(700)]
    df = spark.createDataFrame(data, "t bigint, x int, i int")
    got = running(df, by_day(F.col("t")), [F.col("t"), F.col("i")], {"s": F.col("x")}).orderBy("position").collect()
    total, want = 0, []
    for p, (t, x, i) in enumerate(sorted(data, key=lambda r: (r[0], r[2])), 1):
        total += x
        want.append((p, i, total))
    assert [(r["position"], r["i"], r["s"]) for r in got] == want


def test_sweep_equals_brute_force(spark):
    random.seed(7)
    data = [(i, random.choice([0.1, 0.5, 0.5, 0.9, random.random()]), random.random() < 0.3) for i in range(150)]
    df = spark.createDataFrame(data, "window_start bigint, score double, label boolean")
    positives, tp, best = sum(d[2] for d in data), 0, (-1, 0)
    for rank, (_, score, label) in enumerate(sorted(data, key=lambda d: (-d[1], d[0])), 1):
        tp += label
        f1 = 2 * tp / (rank + positives)
        if f1 > best[0] + 1e-12:
            best = (f1, score)
    assert metrics.best_threshold(df) == best[1]
    assert metrics.best_threshold(df.filter("NOT label")) == math.inf
    assert metrics.best_threshold(df.limit(0)) == math.inf
    assert by_value(df, "score") is not None


def test_confusion_conventions(spark):
    df = spark.createDataFrame([(True, False), (False, False)], "label boolean, predicted boolean")
    row = metrics.confusion(df).first()
    assert (row["true_positives"], row["false_negatives"], row["true_negatives"], row["precision"], row["recall"], row["f1"]) == (0, 1, 1, 0.0, 0.0, 0.0)


def test_split_is_chronological(spark):
    windows = spark.createDataFrame([(i * 60, i % 3 == 0) for i in range(90)], "window_start bigint, is_anomalous boolean")
    parts = {p: [r["window_start"] for r in rows] for p, rows in ((p, split_parts(windows, 0.7, 0.8).filter(F.col("part") == p).collect()) for p in ("fit", "validation", "test"))}
    assert (len(parts["fit"]), len(parts["validation"]), len(parts["test"])) == (49, 13, 28)
    assert max(parts["fit"]) < min(parts["validation"]) <= max(parts["validation"]) < min(parts["test"])
    for bad in (0, 1, 0.001):
        with pytest.raises(ValueError):
            split_parts(windows, bad)


def mixed(spark, n=40):
    rows = []
    for w in range(n):
        rows += [(w * 60 + i, "-", f"n{i}", "INFO", f"ok {i}") for i in range(4)]
        if w % 5 == 0:
            rows += [(w * 60 + 10 + i, "ALERT", "bad", "FATAL", "broken thing") for i in range(20)]
    return log(spark, rows)


def matrix(spark, templates=5):
    events = mixed(spark)
    return build_matrix(aggregate.window_features(events, 60), aggregate.template_counts(events, 60), 0.7, templates)


def test_top_templates_see_training_only(spark):
    rows = [(w * 60 + i, "-", "a", "INFO", "kind A") for w in range(6) for i in range(5)]
    rows += [(w * 60 + i, "-", "a", "INFO", "kind B") for w in range(6, 10) for i in range(50)]
    events = log(spark, rows)
    counts = aggregate.template_counts(events, 60)
    first = events.filter("template = 'kind A'").first()["template_id"]
    assert [r["template_id"] for r in top_templates(counts, BASE + 6 * 60, 1).collect()] == [first]
    assert top_templates(counts, BASE + 6 * 60, 0).count() == 0
    m = build_matrix(aggregate.window_features(events, 60), counts, 0.6, 1)
    assert m.features[-1] == f"tpl_{first}"
    with pytest.raises(ValueError):
        m.without("no such feature")


def test_rule_and_zscore(spark):
    m = matrix(spark)
    row = evaluate.scores(evaluate.rule_predictions(m)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (1.0, 1.0, 1.0)
    assert evaluate.scores(evaluate.zscore_predictions(m)).count() == 2
    z = ZScore.fit(m)
    assert ZScore.load(z.dump()) == z
    with pytest.raises(ValueError):
        ZScore(("a",), (0.0,), (0.0,))


def test_all_seven_detectors(spark):
    predictions = evaluate.evaluate(matrix(spark), rounds=5, trees=20).cache()
    scored = evaluate.scores(predictions)
    assert scored.count() == 7
    assert {r["true_positives"] + r["false_positives"] + r["false_negatives"] + r["true_negatives"] for r in scored.collect()} == {12}
    assert evaluate.report(scored).count("\n") == 7
    learned = {r["detector"]: r["f1"] for r in scored.filter("detector in ('logistic regression', 'severity rule')").collect()}
    assert learned["logistic regression"] > 0.8 and learned["severity rule"] == 1.0


def test_parity_counts_differences(spark):
    a = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, v int")
    b = spark.createDataFrame([(1, 5), (2, 9), (4, 7)], "k int, v int")
    assert tuple(compare.parity(a, b, "k", ["v"]).first()) == (2, 1, 1, 1)


def test_delay_percentiles(spark):
    for n in (1, 2, 7, 40):
        values = [(i * 37) % 100 for i in range(n)]
        row = aggregate.delay_percentiles(spark.createDataFrame([(v,) for v in values], "d bigint"), "d").first()
        ordered = sorted(values)
        assert row["median"] == (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
        assert row["p95"] == ordered[min(n - 1, int(0.95 * n))]
