"""Histogram boosting against plain searches."""

import math

import numpy as np
import pytest

from logloom.operators import boosting, metrics
from logloom.operators.features import Matrix
from logloom.operators.supervised import gradient_boosting


def test_best_split_equals_trying_every_one():
    rng = np.random.default_rng(1)
    for _ in range(30):
        rows, features = 60, 3
        x, g, h = rng.integers(0, 6, (rows, features)), rng.normal(size=rows), rng.uniform(0.01, 0.25, rows)
        sums = np.zeros((3, features, 256))
        for f in range(features):
            for k, v in enumerate((np.ones(rows), g, h)):
                np.add.at(sums[k, f], x[:, f], v)
        best = (0.0, -1, -1)
        for f in range(features):
            for b in range(255):
                left = x[:, f] <= b
                if min(left.sum(), (~left).sum()) >= 20:
                    gain = g[left].sum() ** 2 / h[left].sum() + g[~left].sum() ** 2 / h[~left].sum() - g.sum() ** 2 / h.sum()
                    if gain > best[0] + 1e-9:
                        best = (gain, f, b)
        got = boosting.best_split(*sums)
        assert got[1:] == best[1:] and math.isclose(got[0], best[0], abs_tol=1e-9)


def plain_boosting(x, y, rounds, leaves, least_rows):
    """Scores after so many best-first trees, by plain search over sorted values."""
    share = y.mean()
    raw = np.full(len(y), math.log(share / (1 - share)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)

        def best(rows):
            found = (1e-12, None)
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(a), len(b)) >= least_rows:
                        gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                        if gain > found[0] + 1e-9:
                            found = (gain, (a, b))
            return found

        nodes = [(np.arange(len(y)), *best(np.arange(len(y))))]
        while len(nodes) < leaves:
            at = max(range(len(nodes)), key=lambda i: nodes[i][1] if nodes[i][2] else -1)
            if nodes[at][2] is None:
                break
            a, b = nodes.pop(at)[2]
            nodes += [(a, *best(a)), (b, *best(b))]
        for rows, _, _ in nodes:
            raw[rows] -= 0.1 * g[rows].sum() / h[rows].sum()
    return 1 / (1 + np.exp(-raw))


def table(spark, x, y, parts=3):
    rows = [(i, *map(float, r), bool(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "window_start bigint, " + ", ".join(f"f{i} double" for i in range(x.shape[1])) + ", label boolean").repartition(parts)


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) * 4)
    return x, (x[:, 0] * x[:, 1] + rng.normal(size=n) * 3 + x[:, 2] > 1).astype(float)


def test_trees_equal_plain_best_first_growth(spark):
    x, y = noisy(300, 5)
    model = boosting.fit(table(spark, x, y), ["f0", "f1", "f2"], rounds=4, leaves=7, least_rows=10)
    got = [r["score"] for r in model.scored(table(spark, x, y), ["window_start", "label"]).orderBy("window_start").collect()]
    assert np.allclose(got, plain_boosting(x, y, 4, 7, 10), atol=1e-6)
    assert all(sum(f < 0 for f in t.feature) <= 7 for t in model.trees)


def test_trees_do_not_depend_on_how_rows_are_spread(spark, monkeypatch):
    x, y = noisy(400, 6)
    models = [boosting.fit(table(spark, x, y), ["f0", "f1", "f2"], rounds=3, stopping=True)]
    monkeypatch.setattr(boosting, "IN_HAND", 0)
    for rows in (400, 60):
        monkeypatch.setattr(boosting, "_TASK_ROWS", rows)
        models.append(boosting.fit(table(spark, x, y, 7), ["f0", "f1", "f2"], rounds=3, stopping=True))
    assert all([vars(t) for t in m.trees] == [vars(t) for t in models[0].trees] and m.losses == models[0].losses for m in models[1:])


def test_held_out_loss_stops_the_rounds(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    noise = (rng.random(600) < 0.5).astype(float)
    model = boosting.fit(table(spark, x, noise), ["f0", "f1", "f2"], rounds=60, stopping=True)
    assert boosting.PATIENCE <= model.rounds < 60 and len(model.losses) == model.rounds + 1
    assert min(model.losses[-boosting.PATIENCE :]) > model.losses[-boosting.PATIENCE - 1] - boosting.TOLERANCE
    assert boosting.fit(table(spark, x, noise), ["f0", "f1", "f2"], rounds=5).losses == []


def test_many_values_are_cut_at_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(float(v), float(i % 2), 7.0) for i, v in enumerate(rng.normal(size=5000))], "a double, b double, c double")
    many, two, one = boosting.cut_points(rows, ["a", "b", "c"])
    assert len(many) == 254 and (np.diff(many) > 0).all() and list(two) == [0.5] and len(one) == 0
    share = np.searchsorted(np.sort([r["a"] for r in rows.collect()]), many) / 5000
    assert np.abs(share - np.arange(1, 255) / 255).max() < 0.01


@pytest.mark.parametrize("labels", [0, 1])
def test_one_class_needs_no_trees(spark, labels):
    x, _ = noisy(50, 1)
    model = boosting.fit(table(spark, x, np.full(50, labels)), ["f0", "f1", "f2"])
    assert model.rounds == 0 and abs(model.scored(table(spark, x, np.full(50, labels)), ["window_start"]).first()["score"] - labels) < 1e-5


@pytest.mark.parametrize("seed", range(3))
def test_separable_split(spark, seed):
    """400 training and 2,000 test rows of five features, of which two decide."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(2400, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=2400) * 0.2) > 0.6
    rows = [(i, "fit" if i < 320 else "validation" if i < 400 else "test", bool(y[i]), *map(float, x[i])) for i in range(2400)]
    names = [f"f{i}" for i in range(5)]
    matrix = Matrix(spark.createDataFrame(rows, "window_start bigint, part string, label boolean, " + ", ".join(f"{n} double" for n in names)), tuple(names))
    found = metrics.confusion(gradient_boosting(matrix).filter("part = 'test'"), "rounds").first()
    assert found["f1"] > 0.8 and found["rounds"] == 100
