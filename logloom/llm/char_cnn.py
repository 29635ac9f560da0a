"""A small character convolutional network in numpy.

One-hot characters, a convolution over WIDTH of them, the maximum over all positions,
a hidden layer and a logit. An example is (text, start, end): characters of its
surroundings and those of the candidate itself are different symbols. Examples of any
length are laid end to end with padding between, so none is cut, and long ones are
pooled block by block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np

WIDTH = 5
_PAD = 129  # 128 is any character that isn't ASCII
_INSIDE = 130  # added to the symbols of the candidate
SYMBOLS = 2 * _INSIDE
#: Windows that are held at once when scoring.
_BLOCK = 1 << 15

Example = tuple[str, int, int]


def laid_out(examples: Sequence[Example]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the examples end to end, and where each one's windows start.

    WIDTH - 1 paddings stand between examples, so no window sees two of them.
    """
    gap = np.full(WIDTH - 1, _PAD, np.int16)
    parts, starts, at = [gap], [], 0
    for text, start, end in examples:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.minimum(codes, 128).astype(np.int16)
        codes[start:end] += _INSIDE
        parts += [codes, gap]
        starts.append(at)
        at += len(codes) + WIDTH - 1
    return np.concatenate(parts), np.array(starts, np.int64)


@dataclass(frozen=True)
class Network:
    conv: np.ndarray  # WIDTH, SYMBOLS, filters
    conv_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def new(filters: int = 24, hidden: int = 16, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        scaled = lambda *shape: rng.normal(0, (2 / shape[0]) ** 0.5, shape)
        return Network(rng.normal(0, 0.1, (WIDTH, SYMBOLS, filters)), np.zeros(filters), scaled(filters, hidden), np.zeros(hidden), scaled(hidden), np.zeros(()))

    def _filtered(self, codes: np.ndarray, a: int, b: int, conv: np.ndarray | None = None) -> np.ndarray:
        """Filter values of the windows that start at a to b - 1, less the bias where conv is given."""
        conv, out = (self.conv, np.repeat(self.conv_bias[None], b - a, 0)) if conv is None else (conv, np.zeros((b - a, conv.shape[2]), conv.dtype))
        for k in range(WIDTH):
            out += conv[k].take(codes[a + k : b + k], axis=0)
        return out

    def pooled(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The largest value of each filter over each example's windows."""
        ends = np.append(starts[1:], len(codes) - WIDTH + 1)
        best = np.full((len(starts), len(self.conv_bias)), -np.inf)
        for a in range(0, int(ends[-1]), _BLOCK):
            b = min(a + _BLOCK, int(ends[-1]))
            first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
            cuts = np.maximum(starts[first:last], a) - a
            best[first:last] = np.maximum(best[first:last], np.maximum.reduceat(self._filtered(codes, a, b), cuts))
        return best

    def logits(self, examples: Sequence[Example]) -> np.ndarray:
        if not examples:
            return np.zeros(0)
        return self._logits(self.pooled(*laid_out(examples)))

    def _logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(np.maximum(pooled, 0) @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def _peaks(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """pooled(), and the windows where the values are reached: the first of equals."""
        ends = np.append(starts[1:], len(codes) - WIDTH + 1)
        filters = len(self.conv_bias)
        best, at, conv = np.full((len(starts), filters), -np.inf, np.float32), np.zeros((len(starts), filters), np.int64), self.conv.astype(np.float32)
        for a in range(0, int(ends[-1]), _BLOCK):
            b = min(a + _BLOCK, int(ends[-1]))
            first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
            cuts = np.maximum(starts[first:last], a) - a
            values = self._filtered(codes, a, b, conv)  # single precision finds the place, the value there is exact
            top = np.maximum.reduceat(values, cuts)
            owner = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, b - a)))
            row, column = np.nonzero(values == top[owner])
            place = np.zeros_like(at[first:last])
            place[owner[row[::-1]], column[::-1]] = a + row[::-1]
            better = top > best[first:last]
            best[first:last] = np.where(better, top, best[first:last])
            at[first:last] = np.where(better, place, at[first:last])
        return self.conv_bias + sum(self.conv[k][codes[at + k], np.arange(filters)] for k in range(WIDTH)), at

    def gradients(self, examples: Sequence[Example], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean log loss, in the order of the fields."""
        codes, starts = laid_out(examples)
        best, at = self._peaks(codes, starts)
        shown = np.maximum(best, 0)
        inner = shown @ self.hidden + self.hidden_bias
        active = np.maximum(inner, 0)
        d_out = (1 / (1 + np.exp(-(active @ self.out + self.out_bias))) - labels) * weights / weights.sum()
        d_inner = np.outer(d_out, self.out) * (inner > 0)
        d_best = d_inner @ self.hidden.T * (best > 0)
        d_conv = np.zeros_like(self.conv)
        filters = np.broadcast_to(np.arange(best.shape[1]), best.shape)
        for k in range(WIDTH):
            np.add.at(d_conv[k], (codes[at + k], filters), d_best)
        return [d_conv, d_best.sum(0), shown.T @ d_inner, d_inner.sum(0), active.T @ d_out, d_out.sum()]


NAMES = tuple(Network.__dataclass_fields__)


@dataclass(frozen=True)
class State:
    """A network on its way: its fields, Adam's two moments of each, and the steps gone."""

    network: Network
    moments: tuple[tuple[np.ndarray, np.ndarray], ...]
    step: int = 0

    @staticmethod
    def new(seed: int = 0) -> State:
        net = Network.new(seed=seed)
        return State(net, tuple((np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in NAMES))

    def flat(self) -> np.ndarray:
        """All values in a row, the second moments by their roots."""
        return np.concatenate([np.ravel(x) for n, m in zip(NAMES, self.moments, strict=True) for x in (getattr(self.network, n), m[0], np.sqrt(m[1]))])

    def filled(self, values: np.ndarray, step: int) -> State:
        """The state of these values, as flat() gives them."""
        parts, at = [], 0
        for n in NAMES:
            shape, size = getattr(self.network, n).shape, getattr(self.network, n).size
            parts.append([values[at + i * size : at + (i + 1) * size].reshape(shape) for i in range(3)])
            at += 3 * size
        return State(Network(*(p[0] for p in parts)), tuple((p[1], p[2] ** 2) for p in parts), step)


def passed(state: State, examples: Sequence[Example], labels: np.ndarray, batch: int = 128, rate: float = 0.01, seed: int = 0) -> State:
    """One pass of Adam over all examples; both classes weigh alike. The same examples give the same network."""
    rng, net, step = np.random.default_rng(seed), state.network, state.step
    labels = np.asarray(labels, float)
    share = labels.mean()
    weights = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    moments = [(m.copy(), v.copy()) for m, v in state.moments]
    order = rng.permutation(len(examples))
    for i in range(0, len(order), batch):
        own = order[i : i + batch]
        step += 1
        new = {}
        for name, grad, (m, v) in zip(NAMES, net.gradients([examples[j] for j in own], labels[own], weights[own]), moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            new[name] = getattr(net, name) - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        net = replace(net, **new)
    return State(net, tuple(moments), step)


def train(examples: Sequence[Example], labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.01, seed: int = 0) -> Network:
    state = State.new(seed)
    for epoch in range(epochs):
        state = passed(state, examples, labels, batch, rate, seed + epoch)
    return state.network


def calibrated(logits: np.ndarray, labels: np.ndarray, steps: int = 50, counts: np.ndarray | None = None) -> tuple[float, float]:
    """a and b of the probability 1 / (1 + exp(-(a logit + b))), by Newton steps on
    targets that are drawn in from 0 and 1 as Platt has it. counts: how often each occurs."""
    often = np.ones(len(labels)) if counts is None else counts
    n = (often * labels).sum()
    target = np.where(labels == 1, (n + 1) / (n + 2), 1 / (often.sum() - n + 2))
    x, w = np.stack([logits, np.ones_like(logits)], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (often * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, x.T @ (often * (p - target))), -1, 1)
    return float(w[0]), float(w[1])
