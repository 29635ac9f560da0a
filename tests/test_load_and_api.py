"""Loads, replaced slices, read queries and the command line."""

import pytest
from pyspark.sql import functions as F

from logloom import cli
from logloom.operators import load
from logloom.plans import api
from logloom.sources import schemas

LINE = "{label} {epoch} 2005.06.03 {node} 2005-06-03-15.42.50.363779 {node} RAS KERNEL {severity} {message}"


def lines(spark, source, n, bad=0):
    rows = [(source, i, LINE.format(label="-" if i % 5 else "X", epoch=1117838520 + 20 * i, node=f"n{i % 3}", severity="INFO" if i % 5 else "FATAL", message=f"thing {i}")) for i in range(1, n + 1)]
    return spark.createDataFrame(rows + [(source, n + k, "broken") for k in range(1, bad + 1)], "source_file string, line_no bigint, value string")


def test_second_load_adds_nothing(spark, tmp_path):
    w = str(tmp_path / "w")
    assert load.load(spark, lines(spark, "a", 30, 2), w) == {"lines_read": 32, "rows_inserted": 30, "rows_duplicate": 0, "lines_quarantined": 2}
    assert load.load(spark, lines(spark, "a", 30, 2), w) == {"lines_read": 32, "rows_inserted": 0, "rows_duplicate": 30, "lines_quarantined": 2}
    assert load.load(spark, lines(spark, "b", 30), w)["rows_inserted"] == 30
    count = lambda t: spark.read.parquet(f"{w}/{t}").count()
    assert (count("log_events"), count("quarantined_lines"), count("event_templates"), load.runs(spark, w).count()) == (60, 2, 1, 3)
    assert {r["finished_at"] is None for r in load.runs(spark, w).collect()} == {False}
    events = load.table(spark, w, "log_events", schemas.LOG_EVENTS)
    assert load.orphans(events, load.table(spark, w, "event_templates", schemas.TEMPLATES)).isEmpty()


def test_refresh_replaces_one_size(spark, tmp_path):
    w = str(tmp_path / "w")
    load.load(spark, lines(spark, "a", 30), w)
    first = load.refresh_windows(spark, w, 60)
    load.refresh_windows(spark, w, 300)
    assert load.refresh_windows(spark, w, 60) == first
    sums = {r["window_seconds"]: r["n"] for r in spark.read.parquet(f"{w}/window_features").groupBy("window_seconds").agg(F.sum("event_count").alias("n")).collect()}
    assert sums == {60: 30, 300: 30}


def test_failed_load_leaves_an_open_run_and_is_run_again(spark, tmp_path, monkeypatch):
    w = str(tmp_path / "w")
    monkeypatch.setattr(load, "absent", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load.load(spark, lines(spark, "a", 10), w)
    assert [r["finished_at"] for r in load.runs(spark, w).collect()] == [None]
    assert not [x for x in (tmp_path / "w").iterdir() if x.name.startswith("_staged")]
    monkeypatch.undo()
    assert load.load(spark, lines(spark, "a", 10), w)["rows_inserted"] == 10
    assert sorted((r["run_id"], r["finished_at"] is None) for r in load.runs(spark, w).collect()) == [(1, True), (2, False)]


def test_a_size_without_rows_loses_its_slice(spark, tmp_path):
    w = str(tmp_path / "w")
    rows = spark.createDataFrame([(60, 1), (300, 2)], "window_seconds int, x int")
    load.replace_slice(rows, w, "t", 60)
    load.replace_slice(rows.limit(0), w, "t", 60)
    assert [tuple(r) for r in spark.read.parquet(f"{w}/t").select("window_seconds", "x").collect()] == [(300, 2)]


def test_evaluation_is_stored_and_replaced(spark, tmp_path, capsys):
    log = tmp_path / "x.log"
    log.write_text("\n".join(r["value"] for r in lines(spark, "x", 90).orderBy("line_no").collect()))
    base = ["--warehouse", str(tmp_path / "w")]
    cli.main([*base, "run", str(log)], spark)
    cli.main([*base, "evaluate"], spark)
    out = capsys.readouterr().out
    assert out.count("severity rule") == 2 and "gradient boosting" in out
    scores = spark.read.parquet(str(tmp_path / "w/detector_scores"))
    predictions = spark.read.parquet(str(tmp_path / "w/window_predictions"))
    assert scores.count() == 7 and predictions.select("detector", "variant").distinct().count() == 7
    assert predictions.count() == 7 * predictions.select("window_start").distinct().count()
    rule = scores.filter("detector = 'severity rule'").first()
    assert rule["true_positives"] + rule["false_negatives"] + rule["false_positives"] + rule["true_negatives"] == predictions.select("window_start").distinct().count()


def test_read_queries(spark):
    windows = spark.createDataFrame([(60 * i, 5, 1, 1, 0.0, 0, i == 3) for i in range(5)], "window_start bigint, event_count bigint, distinct_nodes bigint, distinct_templates bigint, error_rate double, alert_count bigint, is_anomalous boolean")
    predictions = spark.createDataFrame([(180, "z-score", "all", True), (180, "severity rule", "-", False), (240, "z-score", "all", False)], "window_start bigint, detector string, variant string, predicted boolean")
    page = api.windows_page(windows, predictions).collect()
    assert [r["detector_flags"] for r in page] == [{}, {}, {}, {"severity rule": False, "z-score (all)": True}, {"z-score (all)": False}]
    assert [r["window_start"] for r in api.windows_page(windows, predictions, 1, 1, True).collect()] == [240]
    assert api.first_anomalous(windows, predictions).first()[0] == 0
    assert api.first_anomalous(windows, predictions.limit(0)).first()[0] is None
    row = api.summary(windows, predictions).first()
    assert (row["windows"], row["anomalous_windows"], row["events"], row["scored_windows"]) == (5, 1, 25, 2)
    for bad in ({"limit": 0}, {"limit": 5001}, {"offset": -1}):
        with pytest.raises(ValueError):
            api.windows_page(windows, predictions, **bad)
    with pytest.raises(ValueError):
        api.summary(windows.limit(0), predictions)
    with pytest.raises(ValueError):
        schemas.require(windows, ("window_start",), exact=True)


def test_command_line(spark, tmp_path, capsys):
    log = tmp_path / "x.log"
    log.write_text("\n".join(r["value"] for r in lines(spark, "x", 60).orderBy("line_no").collect()))
    base = ["--warehouse", str(tmp_path / "w")]
    cli.main([*base, "load", str(log)], spark)
    cli.main([*base, "aggregate"], spark)
    cli.main([*base, "export-stats"], spark)
    out = capsys.readouterr().out
    assert '"rows_inserted": 60' in out and '"version": 1' in out
    (tmp_path / "stats.json").write_text(out[out.index("{\n") :])
    cli.main([*base, "produce", str(log), str(tmp_path / "topic")], spark)
    cli.main([*base, "consume", str(tmp_path / "topic"), str(tmp_path / "out"), "--stats", str(tmp_path / "stats.json")], spark)
    closed = spark.read.parquet(str(tmp_path / "out/out"))
    assert closed.count() > 0 and "flagged" in closed.columns
