"""All detectors over one split, their scores, storage and report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import detector_label
from logloom.operators.detect import TRAIN, ZScore, severity_rule
from logloom.operators.features import Matrix
from logloom.operators.iforest import isolation_forest
from logloom.operators.metrics import confusion
from logloom.operators.supervised import gradient_boosting, logistic_regression

ALL, FREE = "all", "severity-free"
LEAST_WINDOWS = 10


def _named(scored: DataFrame, detector: str, variant: str, ordinal: int) -> DataFrame:
    test = scored.filter("part = 'test'")
    return test.select(F.lit(ordinal).alias("ordinal"), F.lit(detector).alias("detector"), F.lit(variant).alias("variant"), "window_start", "label", "predicted")


def rule_predictions(matrix: Matrix) -> DataFrame:
    return _named(matrix.rows.withColumn("predicted", severity_rule(matrix.rows)), "severity rule", "-", 0)


def zscore_predictions(matrix: Matrix) -> DataFrame:
    """Both variants of the z-score baseline."""
    parts = []
    for ordinal, (variant, m) in enumerate(((ALL, matrix), (FREE, matrix.severity_free())), 1):
        parts.append(_named(m.rows.withColumn("predicted", ZScore.fit(m).predict()), "z-score", variant, ordinal))
    return parts[0].unionByName(parts[1])


def learned_predictions(matrix: Matrix, rounds: int = 100, trees: int = 200) -> DataFrame:
    """Isolation forest in both variants, logistic regression and gradient boosting."""
    free = matrix.severity_free()
    makers: list[tuple[str, str, Callable[[], DataFrame]]] = [
        ("isolation forest", ALL, lambda: isolation_forest(matrix, trees)),
        ("isolation forest", FREE, lambda: isolation_forest(free, trees)),
        ("logistic regression", FREE, lambda: logistic_regression(free)),
        ("gradient boosting", FREE, lambda: gradient_boosting(free, rounds)),
    ]
    out = None
    for ordinal, (detector, variant, make) in enumerate(makers, 3):
        part = _named(make(), detector, variant, ordinal)
        out = part if out is None else out.unionByName(part)
    return out


def evaluate(matrix: Matrix, rounds: int = 100, trees: int = 200) -> DataFrame:
    """Long predictions of the test windows by all seven detectors."""
    return rule_predictions(matrix).unionByName(zscore_predictions(matrix)).unionByName(learned_predictions(matrix, rounds, trees))


def scores(predictions: DataFrame) -> DataFrame:
    """One row of confusion counts and scores per detector and variant."""
    return confusion(predictions, "ordinal", "detector", "variant")


def best(scored: DataFrame) -> DataFrame:
    """The detector of the highest F1; the first of equals."""
    return scored.orderBy(F.desc("f1"), "ordinal").limit(1)


def split_description(matrix: Matrix) -> dict:
    """Windows, spans and anomalous windows of the training and the test part, and the cutoff."""
    train = F.col("part").isin(*TRAIN)
    facts = {"windows": F.count(F.lit(1)), "first": F.min("window_start"), "last": F.max("window_start"), "anomalous": F.count_if("label")}
    rows = {r["train"]: r for r in matrix.rows.groupBy(train.alias("train")).agg(*(f.alias(n) for n, f in facts.items())).collect()}
    return {"train": rows[True].asDict(), "test": rows[False].asDict(), "cutoff": rows[False]["first"], "features": len(matrix.features), "severity_free": len(matrix.severity_free().features)}


def _split_lines(split: dict, window_seconds: int) -> list[str]:
    at = lambda epoch: datetime.fromtimestamp(epoch, UTC).isoformat()
    train, test = split["train"], split["test"]
    share = lambda p: f"{p['anomalous']} of {p['windows']} ({p['anomalous'] / p['windows']:.2%})"
    return [
        f"window size: {window_seconds} s; windows: {train['windows']} train, {test['windows']} test",
        f"cutoff: {at(split['cutoff'])}; train: {at(train['first'])} to {at(train['last'])}; test: {at(test['first'])} to {at(test['last'])}",
        f"anomalous windows: {share(train)} train, {share(test)} test",
        f"features: {split['features']}, {split['severity_free']} of them severity-free",
        "",
    ]


def report(scored: DataFrame, split: dict | None = None, window_seconds: int = 60) -> str:
    """Text table of the scores and confusion counts, by rank, under a description of the split
    and of the best F1 where that is given; the first row is the best one, the first of equals."""
    label = detector_label(F.col("detector"), F.col("variant")).alias("name")
    counts = ("true_positives", "false_positives", "false_negatives", "true_negatives")
    rows = scored.orderBy(F.desc("f1"), "ordinal").select(label, "precision", "recall", "f1", *counts).collect()
    lines = _split_lines(split, window_seconds) if split else []
    if split and rows:
        lines[-1:] = [f"best F1: {rows[0]['f1']:.4f}, that of the first row", ""]
    lines.append(f"{'detector':<40} {'precision':>9} {'recall':>9} {'f1':>9} {'TP':>7} {'FP':>7} {'FN':>7} {'TN':>7}")
    lines += [f"{r['name']:<40} {r['precision']:>9.4f} {r['recall']:>9.4f} {r['f1']:>9.4f} " + " ".join(f"{r[c]:>7}" for c in counts) for r in rows]
    return "\n".join(lines)
