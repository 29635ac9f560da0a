"""Rules of the tables, one commit a load, refreshed days, and the commands for them."""

import json

import pytest
from pyspark.sql import functions as F
from test_load_and_api import LINE, lines

from logloom import cli
from logloom.operators import aggregate, constraints, evaluate, load
from logloom.sources import schemas
from logloom.streaming import sink


def days(spark, source, wanted):
    rows = [(source, i, LINE.format(label="-", epoch=1117843200 + 86400 * d + 600 * k, node=f"n{k % 3}", severity="INFO", message=f"thing {k}")) for i, (d, k) in enumerate(wanted, 1)]
    return spark.createDataFrame(rows, "source_file string, line_no bigint, value string")


def seen(spark, w, name="log_events"):
    return load.table(spark, w, name).count()


@pytest.mark.parametrize("lost", ["quarantined_lines", "closing"])
def test_a_lost_load_is_invisible_until_it_is_run_again(spark, tmp_path, monkeypatch, lost):
    w = str(tmp_path)
    load.load(spark, lines(spark, "a", 10, 1), w)
    before = [seen(spark, w, n) for n in load.LOADED]
    more = lines(spark, "b", 20, 3).unionByName(days(spark, "c", [(0, 0)]).withColumn("value", F.regexp_replace("value", "thing 0", "another kind")))
    if lost == "closing":
        audit = load._audit
        monkeypatch.setattr(load, "_audit", lambda *a: 1 / 0 if a[6] is not None else audit(*a))
    else:
        # Lost once this table was written: the counting of the next, or of this one, fails.
        find, calls = load.absent, []
        order = ["event_templates", "quarantined_lines", "log_events"]
        monkeypatch.setattr(load, "absent", lambda *a: (calls.append(1), 1 / 0 if len(calls) > order.index(lost) + (lost != "log_events") else find(*a))[1])
    with pytest.raises(ZeroDivisionError):
        load.load(spark, more, w)
    monkeypatch.undo()
    assert [seen(spark, w, n) for n in load.LOADED] == before
    assert load.load(spark, more, w)["rows_inserted"] == 21
    assert [seen(spark, w, n) for n in load.LOADED] == [31, 4, before[2] + 1]
    # What the lost run had written is gone.
    assert spark.read.parquet(f"{w}/log_events").count() == 31
    assert constraints.of_warehouse(spark, w).filter("violations > 0").isEmpty()


def test_a_refresh_rebuilds_touched_days_alone(spark, tmp_path):
    w = str(tmp_path / "w")
    load.load(spark, days(spark, "a", [(d, k) for d in range(4) for k in range(9)]), w)
    load.refresh_windows(spark, w, 60)
    files = lambda: {f.relative_to(tmp_path): f.stat().st_mtime_ns for f in (tmp_path / "w/window_features").rglob("*.parquet")}
    first = files()
    assert load.touched_days(spark, w, 60) == ([], 1)
    load.load(spark, days(spark, "b", [(2, k) for k in range(5, 12)]), w)
    assert load.touched_days(spark, w, 60)[0] == ["2005-06-06"]
    load.refresh_windows(spark, w, 60)
    after = files()
    assert {str(f).split("day=")[1][:10] for f in {*first.items()} ^ {*after.items()} for f in [f[0]]} == {"2005-06-06"}
    shown = lambda at, n: sorted(map(str, load.table(spark, at, n).collect()))
    now = [shown(w, n) for n in ("window_features", "window_template_counts")]
    load.refresh_windows(spark, w, 60, full=True)
    assert [shown(w, n) for n in ("window_features", "window_template_counts")] == now
    want = aggregate.window_features(load.table(spark, w, "log_events"), 60)
    assert sorted(map(tuple, load.table(spark, w, "window_features").select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    # Another size starts with all days.
    assert len(load.touched_days(spark, w, 300)[0]) == 4


def test_windows_across_midnight(spark, tmp_path):
    w = str(tmp_path / "w")
    at = [(0, 140), (0, 143), (1, 0), (1, 3)]  # 23:20, 23:50, 00:00, 00:30; windows of 7,000 s straddle midnight
    load.load(spark, days(spark, "a", at[:2] + [(2, 5)]), w)
    load.refresh_windows(spark, w, 7000)
    load.load(spark, days(spark, "b", at[2:]), w)
    load.refresh_windows(spark, w, 7000)
    want = aggregate.window_features(load.table(spark, w, "log_events"), 7000)
    assert sorted(map(tuple, load.table(spark, w, "window_features").select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_each_rule_is_counted_and_named(spark, tmp_path):
    w = str(tmp_path)
    load.load(spark, lines(spark, "a", 60, 2), w)
    load.refresh_windows(spark, w, 60)
    tables = {n: load.table(spark, w, n) for n in load.TABLES if n not in ("ingest_runs", "window_refreshes", "detector_scores", "window_predictions")} | {"ingest_runs": load.runs(spark, w)}
    assert constraints.violations(tables).filter("violations > 0").isEmpty()

    def broken(**new):
        rows = constraints.violations(tables | new).filter("violations > 0").collect()
        return {(r["table"], r["rule"]): r["violations"] for r in rows}

    for name, columns in schemas.NOT_NULL.items():
        if name in tables:
            for c in columns:
                kind = dict(tables[name].dtypes)[c]
                found = broken(**{name: tables[name].withColumn(c, F.lit(None).cast(kind))})
                assert found[name, f"{c}_not_null"] == tables[name].count(), (name, c)
                break  # every column is declared alike; the first one of each table
    for name in ("log_events", "window_features"):
        assert broken(**{name: tables[name].unionByName(tables[name].limit(1))})[name, "key_is_unique"] == 1
    one = F.col("line_no") == 7
    for rule, change in {
        "line_no_from_1": {"line_no": F.when(one, 0).otherwise(F.col("line_no"))}, "epoch_in_span": {"epoch": F.when(one, 5).otherwise(F.col("epoch"))},
        "time_is_epoch": {"epoch": F.when(one, F.col("epoch") + 1).otherwise(F.col("epoch"))}, "known_severity": {"severity": F.when(one, "NOTE").otherwise(F.col("severity"))},
        "digest_of_64": {"line_sha256": F.when(one, "ab").otherwise(F.col("line_sha256"))}, "template_id_in_event_templates": {"template_id": F.when(one, "x").otherwise(F.col("template_id"))},
    }.items():
        assert broken(log_events=tables["log_events"].withColumns(change))["log_events", rule] == 1, rule
    for rule, change in {
        "on_the_grid": {"window_start": F.col("window_start") + 1}, "some_event": {"event_count": F.lit(0)}, "severities_add_up": {"info_count": F.col("info_count") + 1},
        "rate_is_a_share": {"error_rate": F.lit(1.5)}, "anomalous_by_alerts": {"is_anomalous": ~F.col("is_anomalous")},
    }.items():
        assert broken(window_features=tables["window_features"].withColumns(change))["window_features", rule] == tables["window_features"].count(), rule
    assert broken(ingest_runs=tables["ingest_runs"].withColumn("lines_read", F.lit(1).cast("long")))["ingest_runs", "counts_add_up"] == 1


def test_init_reset_and_check(spark, tmp_path, capsys):
    w, log = str(tmp_path / "w"), tmp_path / "x.log"
    log.write_text("\n".join(r["value"] for r in lines(spark, "x", 30).orderBy("line_no").collect()))
    base = ["--warehouse", w]
    assert cli.main([*base, "init"], spark) == 0 and cli.main([*base, "check"], spark) == 0
    assert seen(spark, w) == 0 and set(json.loads(capsys.readouterr().out.splitlines()[0])["tables"]) == set(load.TABLES)
    cli.main([*base, "load", str(log)], spark)
    cli.main([*base, "init"], spark)
    assert seen(spark, w) == 30 and cli.main([*base, "check"], spark) == 0
    load.table(spark, w, "log_events").limit(1).withColumns({"run_id": F.lit(1).cast("long"), "file_bucket": F.lit(0)}).write.mode("append").partitionBy("run_id", "file_bucket").parquet(f"{w}/log_events")
    capsys.readouterr()
    assert cli.main([*base, "check"], spark) == 1
    assert {r["rule"] for r in json.loads(capsys.readouterr().out)} == {"key_is_unique"}
    cli.main([*base, "init", "--reset"], spark)
    assert seen(spark, w) == 0 and load.runs(spark, w).count() == 0


def test_report_has_split_counts_and_best(spark):
    rows = [("z-score", "all", 1, 3, 1, 2, 4), ("severity rule", "-", 0, 3, 1, 2, 4), ("z-score", "severity-free", 2, 0, 1, 5, 4)]
    scored = spark.createDataFrame(rows, "detector string, variant string, ordinal int, true_positives bigint, false_positives bigint, false_negatives bigint, true_negatives bigint")
    scored = scored.withColumns({"precision": F.lit(0.75), "recall": F.lit(0.6), "f1": F.when(F.col("true_positives") > 0, 0.6667).otherwise(0.0)})
    split = {"train": {"windows": 7, "first": 0, "last": 360, "anomalous": 2}, "test": {"windows": 3, "first": 420, "last": 540, "anomalous": 1}, "cutoff": 420, "features": 12, "severity_free": 5}
    text = evaluate.report(scored, split, 60).splitlines()
    assert "7 train, 3 test" in text[0] and "1970-01-01T00:07:00+00:00" in text[1] and "2 of 7 (28.57%) train" in text[2] and text[3].startswith("features: 12, 5")
    assert text[4] == "best F1: 0.6667, that of the first row" and text[5] == ""
    assert text[6].split()[-4:] == ["TP", "FP", "FN", "TN"] and text[7].split()[-4:] == ["3", "1", "2", "4"]
    assert text[7].startswith("severity rule") and len(text) == 10  # the first of equals
    assert len(evaluate.report(scored).splitlines()) == 4


def test_the_index_refuses_other_types(spark, tmp_path):
    assert {*schemas.DOCUMENT, *schemas.DELAYS} == {*schemas.DOCUMENT_TYPES}
    write = sink.upsert(str(tmp_path), columns={"a": "bigint", "b": "string"})
    write(spark.createDataFrame([(1, "x")], "a bigint, b string"), 0)
    for kind in ("a int, b string", "a bigint, b string, c int", "a bigint"):
        with pytest.raises(ValueError):
            write(spark.createDataFrame([], kind), 1)
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_stream_commands(spark, tmp_path, capsys):
    log = tmp_path / "x.log"
    log.write_text("\n".join(r["value"] for r in lines(spark, "x", 60).orderBy("line_no").collect()))
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    cli.main(["produce", str(log), topic, "--limit", "40", "--partitions", "3"], spark)
    assert sum(json.loads(capsys.readouterr().out).values()) == 40
    cli.main(["consume", topic, out, "--partitioned", "--per-trigger", "15", "--idle-timeout", "6"], spark)
    told = json.loads(capsys.readouterr().out)
    assert told["records"] == 40 and told["late_events"] == 0
    assert spark.read.parquet(f"{out}/out").agg(F.sum("event_count")).first()[0] == 40  # the idle time closed the last windows
    with pytest.raises(RuntimeError):
        cli.main(["consume", "some-topic", out, "--kafka"], spark)
