"""Boosting on pre-binned columns.

Rows become one integer per feature (its bin) and equal rows are counted once, so the table that
boosting reads is as large as the number of different (bins, label, split). Its rows are packed
like sparse rows: d entries (feature offset + bin), weight the count, ``ids`` the label and split,
``extra`` the margin so far. A tree grows level by level, one histogram pass per level over
(node, feature, bin); the pass of the root also counts the errors of the trees before. Margins
are rewritten every ``REWRITE`` trees; the trees since then are evaluated in the pass.

A table of at most ``LOCAL_ROWS`` different rows is a summary, whatever the data's size: its
passes run where the model is. A larger one is passed over by the cluster; the code is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import sparse_rows as SR
from tessera.session import forget, written

LOCAL_ROWS = 1 << 16
REWRITE = 10


@dataclass
class Binned:
    """Different rows: a block here, or packed blocks on the cluster; ``bins`` by feature."""
    bins: list[int]
    block: SR.Block | None
    blocks: DataFrame | None = None

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.bins)])

    def sum(self, model, shape: tuple[int, ...], add: Callable) -> np.ndarray:
        if self.block is None:
            return SR.sum_over(self.blocks, model, shape, add)
        total = np.zeros(shape)
        add(total, self.block, model)
        return total

    def close(self) -> None:
        if self.blocks is not None:
            forget(self.blocks)


def binned(df: DataFrame, features: list[str], bins: list[int], label: str, test: str, local_rows: int = LOCAL_ROWS) -> Binned:
    """``features`` hold bins 0 .. bins - 1, ``label`` 0 or 1, ``test`` 0 (learned from) or 1."""
    offsets = np.concatenate([[0], np.cumsum(bins)]).tolist()
    counts = df.groupBy(*features, label, test).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.select((F.col(label) + 2 * F.col(test)).cast("bigint").alias("id"),
                         F.array(*[F.col(f).cast("int") + o for f, o in zip(features, offsets)]).alias("cols"),
                         F.array_repeat(F.col("_n").cast("double"), len(features)).alias("vals"), F.lit(0.0).alias("extra"))
    rows = written(rows, "binned")
    if rows.count() <= local_rows:
        found = rows.orderBy("cols", "id").toArrow()
        forget(rows)
        d = len(features)
        flat = [found.column(c).combine_chunks().flatten().to_numpy() if found.num_rows else np.zeros(0) for c in ("cols", "vals")]
        return Binned(bins, SR.Block(found.column("id").to_numpy(), np.arange(0, found.num_rows * d + 1, d), flat[0].astype(np.int32), flat[1],
                                     found.column("extra").to_numpy()))
    blocks = written(rows.mapInArrow(SR._pack, SR.PACKED), "binned-blocks")
    forget(rows)
    return Binned(bins, None, blocks)


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """A tree as a heap (node i has children 2 i and 2 i + 1): feature (-1: leaf), last bin of the
    left side, leaf value."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n))

    def node(self, bins: np.ndarray) -> np.ndarray:
        at = np.ones(len(bins), dtype=np.int64)
        for _ in range(len(self.feature).bit_length() - 2):
            inner = np.flatnonzero(self.feature[at] >= 0)
            f = self.feature[at[inner]]
            at[inner] = 2 * at[inner] + (bins[inner, f] > self.cut[at[inner]])
        return at


def _bins(block: SR.Block, offsets: np.ndarray) -> np.ndarray:
    d = len(offsets) - 1
    return block.cols.reshape(-1, d) - offsets[:-1]


def _margin(block: SR.Block, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    out = block.extra.copy()
    for t in trees:
        out += t.value[t.node(bins)]
    return out


def _add_level(total, block, model):
    """Gradients and hessians of the training rows by (node of the level, column); at the root,
    weights of all and of wrongly classified rows by split."""
    offsets, trees, tree, level = model
    columns, nodes = int(offsets[-1]), 1 << level
    bins = _bins(block, offsets)
    d = bins.shape[1]
    margin = _margin(block, bins, trees)
    y, test, n = block.ids & 1, block.ids >> 1, block.vals[block.at[:-1]] if len(block.ids) else np.zeros(0)
    p = 1 / (1 + np.exp(-margin))
    at = tree.node(bins) - nodes
    mine = np.flatnonzero((test == 0) & (at >= 0) & (at < nodes))
    key = (at[mine, None] * columns + block.cols.reshape(-1, d)[mine]).ravel()
    size = nodes * columns
    for part, value in enumerate((n * (p - y), n * p * (1 - p))):
        total[part * size:(part + 1) * size] += np.bincount(key, weights=np.repeat(value[mine], d), minlength=size)
    if level == 0:
        wrong = (margin > 0) != (y == 1)
        for s in (0, 1):
            total[2 * size + 2 * s] += n[test == s].sum()
            total[2 * size + 2 * s + 1] += n[(test == s) & wrong].sum()


def _split(tree: Tree, node: int, g: np.ndarray, h: np.ndarray, offsets: np.ndarray, penalty: float, rate: float) -> None:
    """The best cut of a node by gain (ties: the first feature, then bin), with its leaves' values."""
    first = slice(offsets[0], offsets[1])
    gs, hs = g[first].sum(), h[first].sum()
    best = (1e-12, -1, 0, 0.0, 0.0)
    for f in range(len(offsets) - 1):
        lo, hi = offsets[f], offsets[f + 1]
        gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        gain = gl ** 2 / (hl + penalty) + (gs - gl) ** 2 / (hs - hl + penalty) - gs ** 2 / (hs + penalty)
        gain = np.where((hl > 1e-12) & (hs - hl > 1e-12), gain, 0)
        if len(gain) and gain.max() > best[0] * (1 + 1e-12):
            t = int(gain.argmax())
            best = (gain[t], f, t, gl[t], hl[t])
    _, f, t, gl, hl = best
    if f >= 0:
        tree.feature[node], tree.cut[node] = f, t
        tree.value[2 * node] = -rate * gl / (hl + penalty)
        tree.value[2 * node + 1] = -rate * (gs - gl) / (hs - hl + penalty)


def boost(data: Binned, trees: int, depth: int, rate: float = 0.3, penalty: float = 1.0) -> tuple[list[Tree], list[tuple[float | None, float | None]]]:
    """Newton boosting of the log loss (margins from 0, leaf value -rate * G / (H + penalty)):
    the trees, and train and test error after 0, 1, .. trees."""
    offsets = data.offsets
    columns = int(offsets[-1])
    out: list[Tree] = []
    since: list[Tree] = []
    errors = []
    for _ in range(trees + 1):
        tree = Tree.empty(depth)
        for level in range(depth):
            nodes = 1 << level
            if level and not (tree.feature[nodes // 2:nodes] >= 0).any():
                break
            size = nodes * columns
            total = data.sum((offsets, since, tree, level), (2 * size + 4 * (level == 0),), _add_level)
            if level == 0:
                errors.append(tuple(total[2 * size + 2 * s + 1] / total[2 * size + 2 * s] if total[2 * size + 2 * s] else None for s in (0, 1)))
                if len(out) == trees:
                    return out, errors
            g, h = total[:size].reshape(nodes, columns), total[size:2 * size].reshape(nodes, columns)
            for i in range(nodes):
                if level == 0 or tree.feature[(nodes + i) // 2] >= 0:
                    _split(tree, nodes + i, g[i], h[i], offsets, penalty, rate)
        out.append(tree)
        since.append(tree)
        if len(since) == REWRITE:
            _rewrite(data, since)
            since = []
    return out, errors


def _rewrite(data: Binned, trees: list[Tree]) -> None:
    """The margins with the trees so far."""
    offsets = data.offsets
    if data.block is not None:
        data.block.extra = _margin(data.block, _bins(data.block, offsets), trees)
        return

    def run(batches):
        for b in SR.unpacked(batches):
            parts = (b.ids, b.at, b.cols, b.vals, _margin(b, _bins(b, offsets), trees))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["ids", "at", "cols", "vals", "extra"])
    old, data.blocks = data.blocks, written(data.blocks.mapInArrow(run, SR.PACKED), "binned-blocks")
    forget(old)


# ------------------------------------------------------------------ AdaBoost on stumps

def _add_stumps(total, block, model):
    """Weights exp(-y margin) of the training rows by (label, column)."""
    offsets, stumps = model
    bins = _bins(block, offsets)
    margin = np.zeros(len(block.ids))
    for f, left, right, _, alpha in stumps:
        margin += alpha * np.where(bins[:, f] == 0, left, right)
    y, test = block.ids & 1, block.ids >> 1
    n = block.vals[block.at[:-1]] if len(block.ids) else np.zeros(0)
    w = n * np.exp(np.where(y == 1, -margin, margin))
    d, columns = bins.shape[1], int(offsets[-1])
    mine = np.flatnonzero(test == 0)
    key = (y[mine, None] * columns + block.cols.reshape(-1, d)[mine]).ravel()
    total[:2 * columns] += np.bincount(key, weights=np.repeat(w[mine], d), minlength=2 * columns)
    for s in (0, 1):
        total[2 * columns + 2 * s] += n[test == s].sum()
        total[2 * columns + 2 * s + 1] += n[(test == s) & ((margin > 0) != (y == 1))].sum()


def adaboost(data: Binned, rounds: int) -> tuple[list[tuple[int, int, int, float, float]], list[tuple[float | None, float | None]]]:
    """AdaBoost on stumps over 0/1 features: (feature, prediction at 0, at 1, weighted error,
    alpha) of each round, and train and test error after 1, 2, .. of them (sign, 0 -> -1)."""
    offsets, stumps, errors = data.offsets, [], []
    columns = int(offsets[-1])
    for _ in range(rounds + 1):
        total = data.sum((offsets, stumps), (2 * columns + 4,), _add_stumps)
        if stumps:
            errors.append(tuple(total[2 * columns + 2 * s + 1] / total[2 * columns + 2 * s] if total[2 * columns + 2 * s] else None for s in (0, 1)))
        if len(stumps) == rounds:
            break
        q, p = total[:2 * columns].reshape(2, -1, 2)            # negative, positive: (feature, value)
        mistakes = np.minimum(p, q).sum(axis=1)
        f = int(np.argmin(mistakes))
        whole = p[f].sum() + q[f].sum()
        if whole <= 0 or mistakes[f] <= 1e-15:
            break
        err = float(mistakes[f] / whole)
        left, right = (-1 if p[f, v] < q[f, v] else 1 for v in (0, 1))
        stumps.append((f, left, right, err, 0.5 * float(np.log((1 - err) / err))))
    return stumps, errors
