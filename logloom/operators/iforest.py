"""Isolation forest: trees on bounded samples, scored inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.ranking import quantile
from logloom.operators.detect import TRAIN
from logloom.operators.features import Matrix
from logloom.sources.scratch import checkpointed

TREES, SAMPLE, SEED = 200, 256, 42
#: Rows that trees draw from: those of the smallest hash among the training windows.
POOL = 4096


def path_norm(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, depth); a leaf has feature -1 and its expected depth."""
    nodes: list[tuple] = []

    def add(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = part.min(0), part.max(0)
        open_ = np.flatnonzero(low < high)
        if depth >= limit or len(part) <= 1 or not len(open_):
            nodes[at] = (-1, 0.0, 0, 0, depth + path_norm(len(part)))
            return at
        feature = int(rng.choice(open_))
        cut = rng.uniform(low[feature], high[feature])
        left = part[:, feature] < cut
        if not left.any() or left.all():
            cut = high[feature]
            left = part[:, feature] < cut
        a, b = add(part[left], depth + 1), add(part[~left], depth + 1)
        nodes[at] = (feature, float(cut), a, b, 0.0)
        return at

    add(rows, 0)
    return nodes


def depths(nodes: list[tuple], rows: np.ndarray) -> np.ndarray:
    feature, cut, left, right, depth = (np.array(x) for x in zip(*nodes, strict=True))
    at = np.zeros(len(rows), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return depth[at]
        node = at[inner]
        goes = rows[inner, feature[node]] < cut[node]
        at[inner] = np.where(goes, left[node], right[node])


def fit_forest(rows: np.ndarray, trees: int = TREES, seed: int = SEED) -> tuple[list[list[tuple]], int]:
    rng = np.random.default_rng(seed)
    size = min(SAMPLE, len(rows))
    limit = int(np.ceil(np.log2(max(size, 2))))
    return [grow(rows[rng.choice(len(rows), size, replace=False)], rng, limit) for _ in range(trees)], size


def isolation_forest(matrix: Matrix, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """window_start, part, label, score and predicted.

    The share of training windows above the threshold is their anomaly rate,
    held between 1e-6 and 0.5.
    """
    train = matrix.rows.filter(F.col("part").isin(*TRAIN))
    sample = train.orderBy(F.xxhash64("window_start"), "window_start").limit(POOL).select(*matrix.features).toPandas().to_numpy(float)
    forest, size = fit_forest(sample, trees, seed)
    sent = matrix.rows.sparkSession.sparkContext.broadcast(forest)  # trees * 2 * SAMPLE nodes at most
    features = list(matrix.features)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[features].to_numpy(float)
            mean = np.mean([depths(t, rows) for t in sent.value], axis=0) if len(rows) else np.zeros(0)
            yield batch[["window_start", "part", "label"]].assign(score=2.0 ** (-mean / max(path_norm(size), 1e-9)))

    rate = train.agg(F.least(F.greatest(F.avg(F.col("label").cast("double")), F.lit(1e-6)), F.lit(0.5))).first()[0]
    # Scored once: the threshold and the result read the same scores.
    scored = checkpointed(matrix.rows.mapInPandas(score, "window_start bigint, part string, label boolean, score double"))
    threshold = quantile(scored.filter(F.col("part").isin(*TRAIN)), "score", 1 - rate)
    return scored.withColumn("predicted", F.col("score") > F.lit(threshold)).withColumn("threshold", F.lit(float(threshold)))
