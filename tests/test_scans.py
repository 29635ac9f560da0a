"""Quantiles without a sort in one task, numbered lines of split files, and small tables dealt out."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logloom.functions.ranking import quantile
from logloom.sources import log_text, tables


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 0.93, 1.0])
def test_quantile_equals_the_exact_percentile(spark, share):
    rows = spark.range(700).select(F.when(F.col("id") % 50 > 0, (F.col("id") * F.col("id") % 97 - 40) / 7).alias("v"))
    assert quantile(rows, "v", share) == pytest.approx(rows.agg(F.percentile("v", F.lit(share))).first()[0])


def test_lines_of_split_files_are_numbered_and_a_changed_split_fails(spark, tmp_path):
    log = tmp_path / "a.log"
    log.write_text("\n".join(f"line {i} " + "x" * (i % 40) for i in range(1, 4001)))
    name, cores = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = {k: spark.conf.get(k) for k in (name, cores)}
    try:
        spark.conf.set(name, "9000b")
        spark.conf.set(cores, "1b")
        lines = log_text.read_lines(spark, str(log))
        assert all(r["value"].startswith(f"line {r['line_no']} ") for r in lines.collect()) and lines.count() == 4000
        again = log_text.read_lines(spark, str(log))
        spark.conf.set(name, "5000b")
        try:
            found = {r["line_no"]: r["value"] for r in again.collect()}
        except PySparkException as e:
            assert "cut otherwise" in str(e)
        else:  # the scan kept its first plan
            assert all(v.startswith(f"line {n} ") for n, v in found.items()) and len(found) == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_small_tables_are_dealt_out(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    assert tables.read_table(spark, str(tmp_path), "t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "SPREAD_BYTES", 10)
    assert tables.read_table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1


def test_row_groups_that_the_cuts_miss_are_dealt_out(spark, tmp_path):
    spark.range(400_000).selectExpr("id", "sha1(cast(id as string)) AS x").coalesce(1).write.option("parquet.block.size", 1 << 30).parquet(f"{tmp_path}/t.parquet")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "1m")
        assert spark.read.parquet(f"{tmp_path}/t.parquet").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        table = tables.read_table(spark, str(tmp_path), "t")
        held = [r["n"] for r in table.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n")).collect()]
        assert sum(held) == 400_000 and max(held) <= 1.5 * 400_000 / spark.sparkContext.defaultParallelism
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_health_parses_the_events_once(spark, monkeypatch):
    from logloom.plans import queries

    calls, parsed = [], queries._events
    monkeypatch.setattr(queries, "_events", lambda *a: calls.append(a) or parsed(*a))
    folder = "/root/testdata/sf0.001"
    row = queries.rule_zscore_health(spark, folder).first()
    assert len(calls) == 1 and row["events"] == spark.read.parquet(f"{folder}/events.parquet").count()


def test_stored_counts_are_not_multiplied_for_distinct_counts(spark):
    from logloom.operators import aggregate
    from logloom.plans import queries

    folder = "/root/testdata/sf0.001"
    windows, counts = queries._tables(spark, folder)
    assert "Expand" not in windows._jdf.queryExecution().toString()
    events = queries._events(spark, folder)
    for found, want in ((windows, aggregate.window_features(events, queries.HOUR)), (counts, aggregate.template_counts(events, queries.HOUR))):
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
