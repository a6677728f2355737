"""Logistic regression by gradient ascent: one distributed aggregation per iteration.

The feature frame is persisted once; each iteration embeds the current weights
as literals in one projection + aggregation returning d numbers (gradient and,
optionally, the log likelihood at the current weights). Several models (a
penalty grid) advance together in the same pass. Only d-sized state is on the
driver.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.sparse_rows import sum_over


def sigmoid(s: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def log1p_exp_neg(s: Column) -> Column:
    """Overflow-safe log(1 + e^{-s})."""
    return F.when(s < -30, -s).otherwise(F.log1p(F.exp(-s)))


def margin(w, xcols: list[Column]) -> Column:
    e = F.lit(float(w[0])) * xcols[0]
    for wi, x in zip(w[1:], xcols[1:]):
        e = e + F.lit(float(wi)) * x
    return e


def loglik_expr(s: Column, ind: Column) -> Column:
    """(1[y=+1] − 1)·s − log(1 + e^{−s})."""
    return (ind - F.lit(1.0)) * s - log1p_exp_neg(s)


def prepare(df: DataFrame, features: list[Column], label: Column) -> tuple[DataFrame, list[Column]]:
    d = len(features)
    prepared = df.select(*[f.cast("double").alias(f"_x{i}") for i, f in enumerate(features)],
                         F.when(label == 1, 1.0).otherwise(0.0).alias("_ind"))
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    return prepared, [F.col(f"_x{i}") for i in range(d)]


def gradient_ascent(df: DataFrame, features: list[Column], label: Column, step: float,
                    iterations: int, l2s=(0.0,), w0=None, trace: bool = False):
    """Batch gradient ascent for every penalty in ``l2s`` at once.

    Update: w ← w + step·(Σ (1[y=+1] − P(y=+1|x,w))·x − 2·l2·w·[j > 0]).
    Returns ({l2: w}, {l2: [log likelihood at each iterate]}).
    """
    prepared, xs = prepare(df, features, label)
    d = len(xs)
    ws = {l2: (np.zeros(d) if w0 is None else np.array(w0, dtype=float)) for l2 in l2s}
    traces = {l2: [] for l2 in l2s}
    try:
        for _ in range(iterations):
            aggs = []
            for m, l2 in enumerate(l2s):
                s = margin(ws[l2], xs)
                err = F.col("_ind") - sigmoid(s)
                aggs += [F.sum(err * x).alias(f"g{m}_{j}") for j, x in enumerate(xs)]
                if trace:
                    aggs.append(F.sum(loglik_expr(s, F.col("_ind"))).alias(f"ll{m}"))
            r = prepared.agg(*aggs).collect()[0]
            for m, l2 in enumerate(l2s):
                g = np.array([r[f"g{m}_{j}"] for j in range(d)])
                pen = 2.0 * l2 * ws[l2]
                pen[0] = 0.0
                if trace:
                    traces[l2].append(r[f"ll{m}"] - l2 * float(ws[l2][1:] @ ws[l2][1:]))
                ws[l2] = ws[l2] + step * (g - pen)
    finally:
        prepared.unpersist()
    return ws, traces


def gradient_and_loglik(df: DataFrame, features: list[Column], label: Column, w):
    """One pass: ∂ℓ/∂w_j for all j and the log likelihood ℓ at ``w``."""
    ind = F.when(label == 1, 1.0).otherwise(0.0)
    xs = [f.cast("double") for f in features]
    s = margin(w, xs)
    err = ind - sigmoid(s)
    r = df.agg(*[F.sum(err * x).alias(f"g{j}") for j, x in enumerate(xs)],
               F.sum(loglik_expr(s, ind)).alias("ll")).collect()[0]
    return np.array([r[f"g{j}"] for j in range(len(xs))]), r["ll"]


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(s, -700, None)))


def _add_gradient(total: np.ndarray, block, w: np.ndarray) -> None:
    """Gradient by column (all rows but the last) and log likelihood (last row), by model. The
    block's ``extra`` is 1 for the positive class, else 0."""
    x, ind = block.table(len(w)), block.extra[:, None]
    s = block.dot(w) if x is None else x @ w
    err = ind - _sigmoid(s)
    if x is not None:
        total[:-1] += x.T @ err
    else:
        for m in range(w.shape[1]):
            total[:-1, m] += np.bincount(block.cols, weights=block.vals * err[block.row, m], minlength=len(w))
    log1p = np.where(s < -30, -s, np.log1p(np.exp(-np.maximum(s, -30))))
    total[-1] += ((ind - 1.0) * s - log1p).sum(axis=0)


def sparse_ascent(blocks: DataFrame, d: int, models: list[tuple[float, float, int]]):
    """Batch gradient ascent over packed sparse rows (``sparse_rows.pack``; column 0 is the
    intercept, ``extra`` the indicator of the positive class) for many (step, l2, iterations)
    at once: one pass per iteration, whose gradients are added up as arrays in the tasks.
    Returns the weights (d, models) and the penalised log likelihood at them."""
    w = np.zeros((d, len(models)))
    step, l2, iterations = (np.array(x, dtype=float) for x in zip(*models))
    loglik = np.zeros(len(models))
    free = np.arange(d)[:, None] > 0
    tasks = blocks.rdd.getNumPartitions()
    for it in range(int(iterations.max()) + 1):
        at = np.flatnonzero(iterations >= it)           # the last pass of a model gives its likelihood
        total = sum_over(blocks, w[:, at], (d + 1, len(at)), _add_gradient, tasks)
        done = iterations[at] == it
        loglik[at[done]] = total[-1, done] - l2[at[done]] * (w[1:, at[done]] ** 2).sum(axis=0)
        go = at[~done]
        w[:, go] += step[go] * (total[:-1, ~done] - 2 * l2[go] * w[:, go] * free)
    return w, loglik
