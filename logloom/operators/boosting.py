"""Gradient boosting over histograms.

Features are cut into at most 255 bins once. A tree grows best first: each job counts,
for the nodes whose splits may be needed next, gradients by (node, feature, bin) in
the tasks, sums them by a shuffle, and hands the sums, whose number is bounded by
nodes, features and bins, to the driver, which looks for the best splits. Gradients are
summed as whole numbers, so a tree doesn't depend on how rows are spread or in what
order their sums meet.

Tasks hold no state between jobs: a row's score is computed anew from the trees, which
are all that is sent, so a lost executor costs what it had in hand. Up to IN_HAND rows,
which one task would count anyway, are counted on the driver instead of by a job a step;
the sums, and so the trees, are the same.

A held-out slice of the fitted rows stops the rounds once its loss hasn't fallen for
PATIENCE of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Defaults of the published histogram method.
BINS = 255
LEAVES = 31
LEAST_ROWS = 20
RATE = 0.1
LEAST_HESSIAN = 1e-3
HELD_OUT = 0.1
PATIENCE = 10
TOLERANCE = 1e-7
#: Rows above which a slice is held out unless it is said whether to.
STOPS_FROM = 10_000
#: Gradients are summed in this many parts of one.
SCALE = 1 << 30
#: Rows of a task; and rows up to which no jobs are run (a byte a feature each).
_TASK_ROWS = 100_000
IN_HAND = 100_000


def cut_points(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature: between all its values where they are few, else at quantiles."""
    q = lambda c: F.col(f"`{c}`")
    sizes = rows.agg(*(F.approx_count_distinct(q(c)).alias(f"n{i}") for i, c in enumerate(features))).first()
    few = [i for i in range(len(features)) if sizes[f"n{i}"] <= 2 * bins]
    shares = [k / bins for k in range(1, bins)]
    held = [F.collect_set(q(c)) if i in few else F.percentile_approx(q(c), shares, 10_000) for i, c in enumerate(features)]
    row = rows.agg(*(h.alias(f"v{i}") for i, h in enumerate(held))).first()  # at most some hundred values a feature
    out = []
    for i in range(len(features)):
        values = np.unique(np.array(row[f"v{i}"] or [], float))
        if i in few and len(values) > bins:
            values = np.unique(np.quantile(values, shares, method="lower"))
            out.append(values)
        else:
            out.append((values[:-1] + values[1:]) / 2 if i in few else values)
    return out


def binned(rows: DataFrame, features: Sequence[str], cuts: list[np.ndarray], carry: Sequence[str]) -> DataFrame:
    """The carried columns and bins, a byte a feature: how many cuts its value exceeds."""
    schema = rows.select(*carry).withColumn("bins", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty((len(batch), len(cuts)), np.uint8)
            for i, cut in enumerate(cuts):
                found[:, i] = np.searchsorted(cut, batch.column(len(carry) + i).to_numpy(zero_copy_only=False), side="left")
            held = pa.array([r.tobytes() for r in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], held], names=[*carry, "bins"])

    return rows.select(*carry, *(F.col(f"`{c}`").cast("double") for c in features)).mapInArrow(run, schema)


@dataclass
class Tree:
    """Nodes by number, the root 0: feature (-1: a leaf), last bin that goes left, children, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin: int) -> tuple[int, int]:
        """The numbers of the node's new children."""
        a = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, bin, a, a + 1
        for column, filler in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column += [filler] * 2
        return a, a + 1

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        while len(inner := np.flatnonzero(feature[at] >= 0)):
            node = at[inner]
            at[inner] = np.where(bins[inner, feature[node]] <= cut[node], left[node], right[node])
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.places(bins)]


@dataclass(frozen=True)
class Boosted:
    """The cuts, the first score and the trees; losses: of the held-out rows before each round."""

    features: tuple[str, ...]
    cuts: list[np.ndarray]
    first: float
    trees: list[Tree]
    losses: list[float]

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def scored(self, rows: DataFrame, carry: Sequence[str]) -> DataFrame:
        """The carried columns and score, the probability of the label."""
        first, trees = self.first, self.trees
        schema = rows.select(*carry).withColumn("score", F.lit(0.0)).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = _raw(_matrix(batch.column(len(carry)), len(self.cuts)), first, trees)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(1 / (1 + np.exp(-raw)))], names=[*carry, "score"])

        return binned(rows, self.features, self.cuts, carry).mapInArrow(run, schema)


def _matrix(column: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), features)


def _raw(bins: np.ndarray, first: float, trees: list[Tree]) -> np.ndarray:
    out = np.full(len(bins), first)
    for tree in trees:
        out += tree.values(bins)
    return out


def best_split(n: np.ndarray, g: np.ndarray, h: np.ndarray, least_rows: int = LEAST_ROWS) -> tuple[float, int, int]:
    """(gain, feature, bin) of a node's best split out of its counts, gradients and hessians
    (features x bins); the first of equals, and gain 0 where none is allowed."""
    left = [np.cumsum(x, 1)[:, :-1] for x in (n, g, h)]
    whole = [x[0].sum() for x in (n, g, h)]
    right = [w - x for w, x in zip(whole, left, strict=True)]
    fits = (left[0] >= least_rows) & (right[0] >= least_rows) & (left[2] >= LEAST_HESSIAN) & (right[2] >= LEAST_HESSIAN)
    if not fits.any():
        return 0.0, -1, -1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[1] ** 2 / left[2] + right[1] ** 2 / right[2] - whole[1] ** 2 / whole[2]
    gain = np.where(fits, gain, -np.inf)
    feature, bin = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[feature, bin]), int(feature), int(bin)) if gain[feature, bin] > 1e-12 else (0.0, -1, -1)


def _counted(bins: np.ndarray, y: np.ndarray, raw: np.ndarray, at: np.ndarray, nodes: int) -> np.ndarray:
    """n, g and h of each feature's bins (3 x features x nodes * 256); at: a row's node, or -1."""
    total = np.zeros((3, bins.shape[1], nodes * 256), np.int64)
    own = at >= 0
    p = 1 / (1 + np.exp(-raw[own]))
    facts = np.ones(len(p), np.int64), np.rint((p - y[own]) * SCALE).astype(np.int64), np.rint(p * (1 - p) * SCALE).astype(np.int64)
    base = at[own] * 256
    for f in range(bins.shape[1] if len(p) else 0):
        place = base + bins[own, f]
        order = np.argsort(place, kind="stable")
        place = place[order]
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        for k, x in enumerate(facts):  # whole numbers, which bincount would make floating
            total[k, f, place[starts]] = np.add.reduceat(x[order], starts)
    return total


def _loss(y: np.ndarray, raw: np.ndarray) -> int:
    return int(np.rint(np.logaddexp(0, np.where(y, -raw, raw)) * SCALE).sum())


def _among(tree: Tree, nodes: list[int], bins: np.ndarray) -> np.ndarray:
    """Which of the nodes each row is in, or -1."""
    number = np.full(len(tree.feature), -1)
    number[nodes] = np.arange(len(nodes))
    return number[tree.places(bins)]


_SUMS = "node int, feature int, bin int, n bigint, g bigint, h bigint"


class _Spread:
    """Sums over rows that are counted where they are. data: label, held, bins."""

    def __init__(self, data: DataFrame, features: int, first: float):
        self.data, self.features, self.first = data, features, first

    def sums(self, trees: list[Tree], tree: Tree, nodes: list[int], loss: bool) -> dict[int, np.ndarray]:
        """For each node, n, g and h by feature and bin (3 x features x 256); under -1 the held-out
        rows' number and loss, if asked for."""
        features, first = self.features, self.first

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((3, features, len(nodes) * 256), np.int64)
            held_n, held_loss = 0, 0
            for batch in batches:
                bins = _matrix(batch.column(2), features)
                y, held = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (0, 1))
                raw = _raw(bins, first, trees)
                if loss:
                    held_n, held_loss = held_n + int(held.sum()), held_loss + _loss(y[held], raw[held])
                total += _counted(bins, y, raw, np.where(held, -1, _among(tree, nodes, bins)), len(nodes))
            feature, place = np.nonzero(total[0])
            columns = [np.array(nodes, np.int32)[place // 256], feature.astype(np.int32), (place % 256).astype(np.int32), *(t[feature, place] for t in total)]
            if held_n:
                columns = [np.append(c, np.array([v], c.dtype)) for c, v in zip(columns, (-1, 0, 0, held_n, held_loss, 0), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _SUMS.split(", ")])

        summed = self.data.mapInArrow(run, _SUMS).groupBy("node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in "ngh"))
        found = summed.toArrow()  # at most a row a node, feature and bin
        node, feature, bin, *facts = (c.to_numpy() for c in found.columns)
        out = {}
        for number in np.unique(node).tolist():
            own = node == number
            out[number] = np.zeros((3, features, 256), np.int64)
            for k, x in enumerate(facts):
                out[number][k, feature[own], bin[own]] = x[own]
        return out


class _InHand:
    """The same over at most IN_HAND rows, whose scores are carried on from tree to tree."""

    def __init__(self, data: DataFrame, features: int, first: float):
        found = data.toArrow()
        self.y, self.held = (found.column(i).to_numpy().astype(bool) for i in (0, 1))
        self.bins = _matrix(found.column(2).combine_chunks(), features)
        self.raw, self.seen = np.full(len(self.y), first), 0

    def sums(self, trees: list[Tree], tree: Tree, nodes: list[int], loss: bool) -> dict[int, np.ndarray]:
        for done in trees[self.seen :]:
            self.raw += done.values(self.bins)
        self.seen = len(trees)
        total = _counted(self.bins, self.y, self.raw, np.where(self.held, -1, _among(tree, nodes, self.bins)), len(nodes))
        out = dict(zip(nodes, total.reshape(3, -1, len(nodes), 256).transpose(2, 0, 1, 3), strict=True))
        if loss and self.held.any():
            out[-1] = np.zeros((3, len(total[0]), 256), np.int64)
            out[-1][:2, 0, 0] = self.held.sum(), _loss(self.y[self.held], self.raw[self.held])
        return out


def _grown(rows: _Spread | _InHand, features: int, trees: list[Tree], leaves: int, least_rows: int) -> tuple[Tree, float | None]:
    """The next tree, and the held-out loss before it.

    Nodes are looked at in steps: a step counts the children of all nodes that best-first
    growth would split were there no children yet unknown, which is never too few.
    """
    tree, known, loss, wanted = Tree(), {}, None, [0]
    while True:
        sums = rows.sums(trees, tree, wanted, loss=wanted == [0])
        if -1 in sums:
            n, total = sums[-1][:2, 0, 0].tolist()
            loss = total / SCALE / n
        for node in wanted:
            n, g, h = sums.get(node, np.zeros((3, features, 256), np.int64))
            known[node] = (*best_split(n, g / SCALE, h / SCALE, least_rows), float(g[0].sum() / SCALE), float(h[0].sum() / SCALE))
        heap, wanted, chosen = [(-known[0][0], 0)], [], set()
        while heap and len(chosen) < leaves - 1:
            gain, node = heapq.heappop(heap)
            if gain == 0:
                break
            chosen.add(node)
            if tree.left[node] < 0:
                wanted += tree.split(node, *known[node][1:3])
            elif tree.left[node] in known:
                for child in (tree.left[node], tree.right[node]):
                    heapq.heappush(heap, (-known[child][0], child))
        if not wanted:
            break
    # Only what best-first growth chose stays split.
    out, numbers = Tree(), {0: 0}
    for node in sorted(chosen):
        numbers[tree.left[node]], numbers[tree.right[node]] = out.split(numbers[node], tree.feature[node], tree.bin[node])
    for old, new in numbers.items():
        g, h = known[old][3:]
        out.value[new] = -RATE * g / h if h >= LEAST_HESSIAN else 0.0
    return out, loss


def fit(rows: DataFrame, features: Sequence[str], rounds: int = 100, label: str = "label", key: str = "window_start", stopping: bool | None = None, leaves: int = LEAVES, least_rows: int = LEAST_ROWS) -> Boosted:
    """Boost at most `rounds` trees on rows; label is boolean, features are numbers.

    stopping: whether to hold out HELD_OUT of the rows, by a hash of the key, and stop
    by their loss; from STOPS_FROM rows on unless given.
    """
    n, positives = rows.agg(F.count(F.lit(1)), F.count_if(label)).first()
    stopping = n > STOPS_FROM if stopping is None else stopping
    cuts = cut_points(rows, features)
    held = (F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1000)) < int(1000 * HELD_OUT)) if stopping else F.lit(False)
    data = binned(rows.select(F.col(label).alias("label"), held.alias("held"), *(F.col(f"`{c}`") for c in features)), features, cuts, ["label", "held"])
    share = min(max(positives / n, 1e-6), 1 - 1e-6) if n else 0.5
    first, trees, losses = math.log(share / (1 - share)), [], []
    if not 0 < positives < n:
        return Boosted(tuple(features), cuts, first, trees, losses)
    data = data.coalesce(-(-n // _TASK_ROWS)).persist()
    try:
        held_rows = (_InHand if n <= IN_HAND else _Spread)(data, len(features), first)
        while len(trees) < rounds:
            tree, loss = _grown(held_rows, len(features), trees, leaves, least_rows)
            if loss is not None:
                losses.append(loss)
                if len(losses) > PATIENCE and min(losses[-PATIENCE:]) > losses[-PATIENCE - 1] - TOLERANCE:
                    break
            trees.append(tree)
            if len(tree.feature) == 1:
                break  # nothing left to split: further rounds would only repeat it
    finally:
        data.unpersist()
    return Boosted(tuple(features), cuts, first, trees, losses)
