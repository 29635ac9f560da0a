"""Settings from the environment, and the harness that measures the stream."""

import json

import pytest
from test_streams import LINE, lines

from logloom import cli
from logloom.settings import Settings
from logloom.streaming import measure

START = 1120000020  # a full minute


def test_settings():
    assert Settings.from_env({}) == Settings()
    set_ = Settings.from_env({"LOGLOOM_WAREHOUSE": "/w", "LOGLOOM_WINDOW_SECONDS": "300", "LOGLOOM_TRAIN_FRACTION": "0.5", "LOGLOOM_LATENESS": ""})
    assert (set_.tables(), set_.window_seconds, set_.train_fraction, set_.lateness) == ("/w", 300, 0.5, 0)
    with pytest.raises(ValueError, match="LOGLOOM_LATENESS"):
        Settings.from_env({"LOGLOOM_LATENESS": "soon"})
    with pytest.raises(RuntimeError, match="LOGLOOM_WAREHOUSE"):
        Settings().tables()


def test_commands_on_tables_need_their_folder(monkeypatch, spark):
    monkeypatch.delenv("LOGLOOM_WAREHOUSE", raising=False)
    with pytest.raises(RuntimeError, match="LOGLOOM_WAREHOUSE"):
        cli.main(["aggregate"], spark)


def test_throughput_run(spark):
    mixed = lines(spark, [7 * i for i in range(90)]).unionByName(spark.createDataFrame([("f", 500, "broken")], "source_file string, line_no bigint, value string"))
    first, second = (measure.throughput_run(spark, mixed, 60, 2) for _ in range(2))
    # The topic has good lines alone, and a run doesn't see another one's.
    for run in (first, second):
        assert (run["records"], run["rejected"], run["late_events"], run["windows"]) == (90, 0, 0, 11)
        assert run["events_per_second"] == pytest.approx(90 / run["seconds"])


def test_delay_run(spark):
    waits = []
    run = measure.delay_run(spark, lines(spark, [0, 30, 61, 200]), 5, 60, 2, sleep=waits.append)
    assert waits == [12.0, 24.0]
    assert (run["slices"], run["windows"]) == (3, 3)
    assert 0 <= run["median_ms"] <= run["p95_ms"]


def test_delay_run_of_nothing(spark):
    run = measure.delay_run(spark, lines(spark, [0]).limit(0), 5)
    assert run == {"slices": 0, "windows": 0, "median_ms": None, "p95_ms": None}


def test_measure_command(spark, tmp_path, capsys):
    log = tmp_path / "some.log"
    log.write_text("\n".join(LINE.format(epoch=START + 45 * i, node=f"r{i % 4}") for i in range(40)))
    cli.main(["measure", str(log), "--partitions", "2", "--limit", "30"], spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # The thirtieth line is 29 * 45 s after the first, and no minute between is empty.
    assert (out["records"], out["windows"]) == (30, 29 * 45 // 60 + 1)
