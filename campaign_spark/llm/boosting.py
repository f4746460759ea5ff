"""Gradient boosted trees for two classes in numpy, with a calibrated probability.

``grow`` needs of its rows only sums of gradients by node, feature and bin. ``fit`` adds them up over arrays;
``fit_table`` over all rows of a Spark table, of which only these sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard

DEPTH, ROUNDS, RATE = 4, 40, 0.2
BINS = 64
MIN_ROWS = 10  # of a leaf
RIDGE = 1.0
INNER = 2 ** DEPTH - 1
SCALE = 2.0 ** 24  # gradients are added as whole numbers, so that sums don't depend on the order of rows
WRITE = 8  # rounds after which a table's margins are written
TASK_ROWS = 100_000  # rows of a table that a task adds up, about


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Boosted:
    """Trees as heaps: node k has children 2k+1 (not above the threshold) and 2k+2."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> None:
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf
        self.slope, self.shift = 1.0, 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - INNER]
        return out

    def scaled(self, margin: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * margin + self.shift)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(self.margin(x))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.calibrate_margins(self.margin(x), y, np.ones(len(x)))

    def calibrate_margins(self, m: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """Platt scaling on rows not fitted on, ``n`` of each: two parameters by Newton's steps, with smoothed targets."""
        pos = (n * y).sum()
        target = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (n.sum() - pos + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = _logistic(a * m + b)
            g, h = n * (p - target), n * np.maximum(p * (1 - p), 1e-9)
            hess = np.array([[(h * m * m).sum() + 1e-3, (h * m).sum()], [(h * m).sum(), h.sum() + 1e-3]])
            step = np.linalg.solve(hess, [(g * m).sum() + 1e-3 * (a - 1), g.sum()])
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        if np.isfinite([a, b]).all() and a > 0:
            self.slope, self.shift = float(a), float(b)


class Tree:
    """A tree over bins: rows whose bin of ``feature`` is above ``split`` go right; the first ``levels`` levels are there."""

    def __init__(self) -> None:
        self.feature, self.split = np.zeros(INNER, np.int64), np.full(INNER, BINS)
        self.leaf, self.levels = np.zeros(INNER + 1), 0

    def node(self, binned: np.ndarray) -> np.ndarray:
        rows, node = np.arange(len(binned)), np.zeros(len(binned), np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (binned[rows, self.feature[node]] > self.split[node])
        return node


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """bin > b  <=>  x > edges[b], for every feature."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.uint8)


def added(binned: np.ndarray, trees: list[Tree]) -> np.ndarray:
    out = np.zeros(len(binned))
    for t in trees:
        out += t.leaf[t.node(binned) - INNER]
    return out


def sums(binned: np.ndarray, y: np.ndarray, n: np.ndarray, margin: np.ndarray, tree: Tree, sizes: list[int]) -> np.ndarray:
    """(3, nodes of the next level, bins of all features): first and second derivatives and rows."""
    width, nodes = sum(sizes), 2 ** tree.levels
    p = _logistic(margin)
    weights = np.rint((p - y) * SCALE) * n, np.rint(p * (1 - p) * SCALE) * n, n.astype(float)
    at = (tree.node(binned) - (nodes - 1)) * width
    out = np.zeros((3, nodes * width))
    for first, column in zip(np.cumsum([0, *sizes]), binned.T):
        cell = at + first + column
        for total, w in zip(out, weights):
            total += np.bincount(cell, w, nodes * width)
    return out.reshape(3, nodes, width)


def _deepen(tree: Tree, total: np.ndarray, sizes: list[int]) -> None:
    """One more level from the sums of ``sums``; the last one sets the leaves."""
    first = 2 ** tree.levels - 1
    ends = np.cumsum([0, *sizes])
    last = tree.levels == DEPTH - 1
    for k, (g, h, n) in enumerate(total.transpose(1, 0, 2), first):
        gt, ht, nt = (v[:sizes[0]].sum() / s for v, s in ((g, SCALE), (h, SCALE), (n, 1)))
        best, left = 1e-6, (gt, ht)
        for j, (a, b) in enumerate(zip(ends, ends[1:])):
            if b - a < 2 or nt < 2 * MIN_ROWS:
                continue
            gl, hl, nl = np.cumsum(g[a:b])[:-1] / SCALE, np.cumsum(h[a:b])[:-1] / SCALE, np.cumsum(n[a:b])[:-1]
            gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
            gain[(nl < MIN_ROWS) | (nt - nl < MIN_ROWS)] = -1
            i = int(gain.argmax())
            if gain[i] > best:
                best, left, tree.feature[k], tree.split[k] = gain[i], (gl[i], hl[i]), j, i
        if last:
            for side, (gs, hs) in enumerate((left, (gt - left[0], ht - left[1]))):
                tree.leaf[2 * k + 1 + side - INNER] = -RATE * gs / (hs + RIDGE)
    tree.levels += 1


def prior(positive: float, n: float) -> float:
    p = (positive + 1) / (n + 2)
    return float(np.log(p / (1 - p)))


def grow(ask: Callable[[dict, dict], dict[int, np.ndarray]], bases: dict[int, float],
         edges: dict[int, list[np.ndarray]]) -> dict[int, tuple[Boosted, list[Tree]]]:
    """Trees of ``DEPTH`` levels on gradients of the logistic loss, for several sets of rows side by side.

    ``ask(trees, growing)`` returns each set's ``sums`` under its whole trees and the one that grows.
    """
    trees: dict[int, list[Tree]] = {k: [] for k in bases}
    sizes = {k: [len(e) + 1 for e in edges[k]] for k in bases}
    for _ in range(ROUNDS):
        growing = {k: Tree() for k in bases}
        for _ in range(DEPTH):
            total = ask(trees, growing)
            for k, t in growing.items():
                _deepen(t, total[k], sizes[k])
        for k, t in growing.items():
            trees[k].append(t)
    out = {}
    for k, mine in trees.items():
        threshold = [[edges[k][j][b] if b < BINS else np.inf for j, b in zip(t.feature, t.split)] for t in mine]
        out[k] = Boosted(bases[k], np.array([t.feature for t in mine]), np.array(threshold), np.array([t.leaf for t in mine])), mine
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Trees from arrays; splits at quantiles of each feature."""
    edges = [np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for v in x.T]
    binned, base = to_bins(x, edges), prior(y.sum(), len(y))
    margin, n = np.full(len(y), base), np.ones(len(y))
    done = 0

    def ask(trees: dict, growing: dict) -> dict:
        nonlocal done
        margin[:] += added(binned, trees[0][done:])
        done = len(trees[0])
        return {0: sums(binned, y, n, margin, growing[0], [len(e) + 1 for e in edges])}

    return grow(ask, {0: base}, {0: edges})[0][0]


def table_rows(b: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """(set, rows' places, bins, label, number of rows) of each set in a batch whose columns are set, label, b, n."""
    kind = b.column(0).to_numpy()
    binned = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(-1, width)
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        yield int(k), at, binned[at], b.column(1).to_numpy()[at].astype(float), b.column(3).to_numpy()[at]


def fit_table(rows: DataFrame, bases: dict[int, float], edges: dict[int, list[np.ndarray]]) -> dict[int, tuple[Boosted, list[Tree]]]:
    """Trees from all rows of a table (kind, label, b: bins as bytes, n: how many such rows), for each kind.

    Every level of every round is a job that adds up all rows; the driver gets the sums of each task, whose size
    is that of the bins. Margins are written every ``WRITE`` rounds, so that a job walks no more trees than that.
    """
    width = len(next(iter(edges.values())))
    sizes = {k: [len(e) + 1 for e in edges[k]] for k in bases}
    tasks = -(-max(rows.count(), 1) // TASK_ROWS)
    state, written, done = rows, None, 0

    def margins(b: pa.RecordBatch, k: int, at: np.ndarray, binned: np.ndarray, new: dict) -> np.ndarray:
        return (b.column(4).to_numpy()[at] if b.num_columns > 4 else bases[k]) + added(binned, new[k])

    def write(new: dict) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                margin = np.zeros(b.num_rows)
                for k, at, binned, _, _ in table_rows(b, width):
                    margin[at] = margins(b, k, at, binned, new)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(margin)], names=["kind", "label", "b", "n", "margin"])

        return cut(state.coalesce(tasks).mapInArrow(run, "kind tinyint, label tinyint, b binary, n long, margin double"), "boosting-margins")

    def ask(trees: dict, growing: dict) -> dict:
        nonlocal state, written, done
        new = {k: t[done:] for k, t in trees.items()}
        if len(next(iter(new.values()))) >= WRITE:
            state, old = write(new), written
            if old is not None:
                discard(old)
            written, done = state, len(next(iter(trees.values())))
            new = {k: [] for k in trees}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for k, at, binned, y, n in table_rows(b, width):
                    part = sums(binned, y, n, margins(b, k, at, binned, new), growing[k], sizes[k])
                    total[k] = total[k] + part if k in total else part
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int8()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                                 names=["kind", "sums"])

        total = {k: np.zeros((3, 2 ** t.levels, sum(sizes[k]))) for k, t in growing.items()}
        for r in state.coalesce(tasks).mapInArrow(run, "kind tinyint, sums binary").collect():
            total[r["kind"]] += np.frombuffer(r["sums"]).reshape(total[r["kind"]].shape)
        return total

    out = grow(ask, bases, edges)
    if written is not None:
        discard(written)
    return out


def quantiles(values: DataFrame) -> DataFrame:
    """The edges of ``BINS`` bins of each (kind, feature): its quantiles over all rows (kind, feature, value, n)."""
    each = values.groupBy("kind", "feature", "value").agg(F.sum("n").alias("n"))
    upto = each.selectExpr("kind", "feature", "value", "n", "sum(n) over (partition by kind, feature order by value) as upto",
                           "greatest(sum(n) over (partition by kind, feature) - 1, 1) as m")
    # How many of the quantiles' places k * m div BINS, k from 1, are among the values before a place.
    before = lambda place: f"greatest(0, least({BINS - 1}, ({BINS} * ({place}) - 1) div m))"
    return upto.filter(f"{before('upto')} > {before('upto - n')}").select("kind", "feature", "value")
