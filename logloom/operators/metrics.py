"""Confusion counts, scores and the threshold sweep."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.ranking import by_value, running


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / F.when(b == 0, 1).otherwise(b))


def confusion(predictions: DataFrame, *by: str, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Confusion counts with precision, recall and F1 for each group."""
    y, p = F.col(label), F.col(predicted)
    counts = predictions.groupBy(*by).agg(
        F.count_if(y & p).alias("true_positives"),
        F.count_if(~y & p).alias("false_positives"),
        F.count_if(y & ~p).alias("false_negatives"),
        F.count_if(~y & ~p).alias("true_negatives"),
    )
    tp, fp, fn = (F.col(f"{k}s").cast("double") for k in ("true_positive", "false_positive", "false_negative"))
    return counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def sweep(scored: DataFrame, score: str = "score", label: str = "label", tie: str = "window_start") -> DataFrame:
    """position, score and F1 when the rows up to this one, by falling score, are predicted."""
    hit = F.col(label).cast("int")
    rows = running(scored, by_value(scored, score), [F.desc(score), F.asc(tie)], {"tp": hit})
    positives = scored.agg(F.sum(hit).alias("positives"))
    rows = rows.crossJoin(F.broadcast(positives))  # one row
    f1 = ratio(2 * F.col("tp").cast("double"), (F.col("position") + F.col("positives")).cast("double"))
    return rows.withColumn("f1", f1)


def best_threshold(scored: DataFrame, score: str = "score", label: str = "label", tie: str = "window_start") -> float:
    """The score at the first best F1; infinity where there is nothing to find.

    The sweep looks row by row, also inside ties, while predictions take all
    scores from the threshold on.
    """
    swept = sweep(scored, score, label, tie)
    best = swept.filter("positives > 0").orderBy(F.desc("f1"), "position").select(score).first()
    return float(best[0]) if best else math.inf
