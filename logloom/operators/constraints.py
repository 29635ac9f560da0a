"""Declared rules of the tables, counted over stored rows.

A file table keeps no rules by itself. All conditions on single rows of a table are
counted in one pass; keys by one aggregation, references by one anti-join each, both
of which move only the columns of the rule.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import load
from logloom.sources import schemas

_OUT = ("table", "rule", "violations")


def _row_rules(name: str) -> dict[str, str]:
    """The conditions on single rows of a table, by the names of their rules."""
    never = {f"{c}_not_null": f"{c} IS NOT NULL" for c in schemas.NOT_NULL.get(name, ())}
    return never | schemas.CONDITIONS.get(name, {})


def _of_rows(name: str, rows: DataFrame) -> DataFrame:
    """A condition that is null is no violation, as null columns have a rule of their own."""
    rules = _row_rules(name)
    counts = rows.agg(*(F.count_if(~F.coalesce(F.expr(c), F.lit(True))).alias(f"_{i}") for i, c in enumerate(rules.values())))
    listed = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"_{i}").alias("violations")) for i, r in enumerate(rules))))
    return counts.select(F.lit(name).alias("table"), listed.alias("x")).select("table", "x.*")


def _of_key(name: str, rows: DataFrame) -> DataFrame:
    """Rows beyond the first of their key."""
    more = rows.groupBy(*schemas.KEYS[name]).agg((F.count(F.lit(1)) - 1).alias("n"))
    return more.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(name).alias("table"), F.lit("key_is_unique").alias("rule"), "violations")


def _of_reference(name: str, rows: DataFrame, column: str, other: DataFrame, of: str, target: str) -> DataFrame:
    """Rows whose value, not null, the other table lacks."""
    known = other.select(F.col(of).alias("_known")).distinct()
    lost = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    lost = lost.join(known, F.col(column) == F.col("_known"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(name).alias("table"), F.lit(f"{column}_in_{target}").alias("rule"), "violations")


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, rule, violations (0 included) of every rule of the given tables; references to tables
    that aren't given are left out."""
    parts = []
    for name, rows in tables.items():
        if _row_rules(name):
            parts.append(_of_rows(name, rows))
        if name in schemas.KEYS:
            parts.append(_of_key(name, rows))
        for column, target, of in schemas.REFERENCES.get(name, ()):
            if target in tables:
                parts.append(_of_reference(name, rows, column, tables[target], of, target))
    return reduce(DataFrame.unionByName, [p.select(*_OUT) for p in parts])


def of_warehouse(spark: SparkSession, warehouse: str) -> DataFrame:
    """The same of all tables of a warehouse, as readers see them."""
    tables = {n: load.table(spark, warehouse, n) for n in load.TABLES if n != "ingest_runs"}
    return violations(tables | {"ingest_runs": load.runs(spark, warehouse)})
