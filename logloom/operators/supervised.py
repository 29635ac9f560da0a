"""Supervised detectors: fitted on the fit slice, thresholds from the validation slice."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators import boosting
from logloom.operators.features import Matrix
from logloom.operators.metrics import best_threshold

def _scaled(matrix: Matrix) -> DataFrame:
    """Features less the fit slice's mean, over its population deviation (0 counts as 1)."""
    fit = matrix.rows.filter("part = 'fit'")
    stats = fit.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(matrix.features) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    return matrix.rows.withColumns({c: (F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0) for i, c in enumerate(matrix.features)})


def _assembled(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    rows = rows.withColumn("y", F.col("label").cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol="x").transform(rows).select("window_start", "part", "label", "y", "x")


def _thresholded(scored: DataFrame) -> DataFrame:
    """Add predicted and threshold to window_start, part, label, score; no refit after the threshold."""
    scored = scored.cache()
    threshold = best_threshold(scored.filter("part = 'validation'"))
    return scored.withColumn("predicted", F.col("score") >= F.lit(threshold)).withColumn("threshold", F.lit(threshold))


def logistic_regression(matrix: Matrix, max_iter: int = 2000) -> DataFrame:
    rows = _assembled(_scaled(matrix), matrix.features).cache()
    fit = rows.filter("part = 'fit'")
    model = LogisticRegression(featuresCol="x", labelCol="y", maxIter=max_iter, regParam=1 / max(fit.count(), 1), elasticNetParam=0.0, standardization=False, tol=1e-9)
    scored = model.fit(fit).transform(rows)
    return _thresholded(scored.select("window_start", "part", "label", vector_to_array("probability")[1].alias("score")))


def gradient_boosting(matrix: Matrix, rounds: int = 100, stopping: bool | None = None) -> DataFrame:
    """Histogram boosting; also the column rounds, which were gone through before the held-out loss stopped them."""
    model = boosting.fit(matrix.rows.filter("part = 'fit'"), matrix.features, rounds, stopping=stopping)
    scored = model.scored(matrix.rows, ["window_start", "part", "label"])
    return _thresholded(scored).withColumn("rounds", F.lit(model.rounds))
