"""The driver contract, and that the library stands without its optional part."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from logloom.plans import registry

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_nothing_outside_imports_the_optional_part():
    for path in (ROOT / "logloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "logloom.llm" not in path.read_text(), path


def test_entry_without_the_optional_part(tmp_path):
    for name in ("__spark_entry__.py", "logloom"):
        os.symlink(ROOT / name, tmp_path / name) if name.endswith(".py") else (tmp_path / name).mkdir()
    for child in (ROOT / "logloom").iterdir():
        if child.name not in ("llm", "__pycache__"):
            os.symlink(child, tmp_path / "logloom" / child.name)
    (tmp_path / "run.py").write_text((ROOT / "__spark_entry__.py").read_text() + "\nprint(len(queries()), len(oracle_sql()))\n")
    out = subprocess.run([sys.executable, "-B", "run.py"], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, timeout=120)
    assert out.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE_SQL))], out.stderr


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["window_features_3600", "feature_matrix", "zscore_eval", "windows_page", "quarantine_reasons", "lag_percentiles"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SMALL}/events.parquet'")
    frame = registry.QUERIES[name](spark, SMALL)
    cursor = con.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    want = sorted((repr(dict(sorted(zip(columns, r, strict=True)))) for r in cursor.fetchall()))
    assert sorted(repr(dict(sorted(r.asDict().items()))) for r in frame.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
def test_read_queries_have_all_seven_detectors(spark, monkeypatch):
    from logloom.plans import queries

    predictions = queries._predictions(spark, SMALL)
    monkeypatch.setattr(queries, "_predictions", lambda *_: predictions)
    ranked = registry.QUERIES["detector_scores_ranked"](spark, SMALL).collect()
    assert len({(r["detector"], r["variant"]) for r in ranked}) == 7
    assert registry.QUERIES["best_detector"](spark, SMALL).first()["f1"] == max(r["f1"] for r in ranked)
    assert registry.QUERIES["health"](spark, SMALL).first()["detector_scores"] == 7
    for name, column in (("detector_flags", "flags"), ("all_detectors_windows_page", "detector_flags")):
        assert {len(json.loads(r[column])) for r in registry.QUERIES[name](spark, SMALL).collect()} == {7}
    matrix = registry.QUERIES["full_feature_matrix"](spark, SMALL)
    assert sum(c.startswith("tpl_") for c in matrix.columns) == spark.read.parquet(f"{SMALL}/events.parquet").select("event_type").distinct().count()


@pytest.mark.parametrize("name", ["feature_matrix", "zscore_scores", "summary", "first_anomalous_index"])
def test_read_queries_parse_the_events_once(spark, name):
    """What is left to run when the query returns reads counted events, not lines."""
    plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert "regexp_replace" not in plan and "events.parquet" not in plan
