"""Rule, z-score baseline and their statistics."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.features import Matrix
from logloom.operators.metrics import best_threshold
from logloom.sources.schemas import require

TRAIN = ("fit", "validation")


def severity_rule(rows: DataFrame) -> Column:
    require(rows, ("fatal_count", "failure_count"))
    return (F.col("fatal_count") + F.col("failure_count")) > 0


@dataclass(frozen=True)
class ZScore:
    """Means and population deviations of features, and the threshold of the largest deviation."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    threshold: float = math.inf

    def __post_init__(self):
        if not self.features or not len(self.features) == len(self.mean) == len(self.std):
            raise ValueError("features, mean and std must be non-empty and of equal length")
        if any(s == 0 for s in self.std):
            raise ValueError("std must not hold zeros")

    @staticmethod
    def fit(matrix: Matrix) -> ZScore:
        """Statistics of the training windows, and the threshold that is best on their labels.

        The statistics come to the driver once and go on as literals, so the
        threshold and later comparisons see the same numbers.
        """
        train = matrix.rows.filter(F.col("part").isin(*TRAIN))
        stats = train.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(matrix.features) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
        model = ZScore(matrix.features, tuple(stats[f"m{i}"] for i in range(len(matrix.features))), tuple(stats[f"s{i}"] or 1.0 for i in range(len(matrix.features))))
        scored = train.select("window_start", "label", model.score().alias("score"))
        return ZScore(model.features, model.mean, model.std, best_threshold(scored))

    def score(self) -> Column:
        terms = [F.abs((F.col(c) - F.lit(m)) / F.lit(s)) for c, m, s in zip(self.features, self.mean, self.std, strict=True)]
        return reduce(F.greatest, terms) if len(terms) > 1 else terms[0]

    def predict(self) -> Column:
        return self.score() >= F.lit(self.threshold)

    def dump(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def load(text: str) -> ZScore:
        raw = json.loads(text)
        return ZScore(tuple(raw["features"]), tuple(raw["mean"]), tuple(raw["std"]), raw["threshold"])
