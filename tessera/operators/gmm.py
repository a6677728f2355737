"""Gaussian mixtures by EM, one scan per iteration.

Parameters (weights, means, covariances) are model state on the driver; inverse
and log-determinant of each covariance are computed there and embedded as
literals, so every row's k log densities, log-sum-exp and responsibilities are
one projection. The M-step statistics per component — Σr, Σr·δ, Σr·δδᵀ about the old
mean (full), weighted mean and variance (diagonal) — and the log likelihood come from one
aggregation; centred sums keep their digits however far the data lie from zero. A
component that no row belongs to keeps its mean and covariance, with weight near zero.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as V

LOG_2PI = math.log(2 * math.pi)


#: Soft counts below this share of the rows leave a component as it is.
EMPTY = 1e-12


def _log_weight(w: float) -> float:
    return math.log(max(w, 1e-300))


def _lit(x: float) -> Column:
    return F.lit(float(x))


def log_density_full(xs: list[Column], mean, cov) -> Column:
    d = len(xs)
    inv = np.linalg.inv(cov)
    _, logdet = np.linalg.slogdet(cov)
    delta = [xs[i] - _lit(mean[i]) for i in range(d)]
    quad = None
    for i in range(d):
        for j in range(d):
            t = _lit(inv[i, j]) * delta[i] * delta[j]
            quad = t if quad is None else quad + t
    return _lit(-0.5 * (d * LOG_2PI + logdet)) - F.lit(0.5) * quad


def log_density_diag(vec: Column, mean, var) -> Column:
    """Diagonal covariance on an array column: −½ Σ_i [ln(2π σ²_i) + (x_i − μ_i)²/σ²_i]."""
    const = -0.5 * float(np.sum(np.log(2 * math.pi * np.asarray(var))))
    inv = V.lit_vector([1.0 / v for v in var])
    mu = V.lit_vector(mean)
    q = F.aggregate(F.zip_with(F.zip_with(vec, mu, lambda a, b: a - b), inv,
                               lambda dlt, iv: dlt * dlt * iv), F.lit(0.0), lambda acc, t: acc + t)
    return _lit(const) - F.lit(0.5) * q


def log_joint_full(xs, weights, means, covs) -> Column:
    return F.array(*log_joint_cols(xs, weights, means, covs))


def log_joint_cols(xs, weights, means, covs) -> list[Column]:
    return [_lit(_log_weight(w)) + log_density_full(xs, m, c) for w, m, c in zip(weights, means, covs)]


def e_step_columns(df: DataFrame, xs: list[Column], weights, means, covs, keep: list[str]) -> DataFrame:
    """Per row: log joints ``_l{k}``, ``_lse`` and responsibilities ``_r{k}`` as scalar columns."""
    k = len(weights)
    base = df.select(*keep, *[(lj).alias(f"_l{j}") for j, lj in
                              enumerate(log_joint_cols([x.cast("double") for x in xs], weights, means, covs))])
    base = base.select(*keep, *[f"_l{j}" for j in range(k)],
                       _lse([F.col(f"_l{j}") for j in range(k)]).alias("_lse"))
    return base.select(*keep, *[f"_l{j}" for j in range(k)], "_lse",
                       *[F.exp(F.col(f"_l{j}") - F.col("_lse")).alias(f"_r{j}") for j in range(k)])


def log_joint_diag(vec, weights, means, variances) -> Column:
    return F.array(*[_lit(_log_weight(w)) + log_density_diag(vec, m, v)
                     for w, m, v in zip(weights, means, variances)])


def responsibilities(lj: Column) -> Column:
    lse = V.log_sum_exp(lj)
    return F.transform(lj, lambda z: F.exp(z - lse))


def _lse(ljs: list[Column]) -> Column:
    """log Σ exp(z_k) over a few scalar columns (stable; stays in whole-stage codegen)."""
    if len(ljs) == 1:
        return ljs[0]
    m = F.greatest(*ljs)
    return m + F.log(sum(F.exp(z - m) for z in ljs))


def em_step_full(df: DataFrame, xs: list[Column], weights, means, covs):
    """One EM iteration; returns (new weights, means, covs, log likelihood at the old params).
    Log densities, log-sum-exp and responsibilities are scalar columns (no array lambdas),
    so the whole E-step and the M-step sums run in generated code."""
    k, d = len(weights), len(xs)
    base = df.select(*[x.cast("double").alias(f"_x{i}") for i, x in enumerate(xs)])
    cx = [F.col(f"_x{i}") for i in range(d)]
    ljs = [(_lit(_log_weight(w)) + log_density_full(cx, m, c)).alias(f"_l{j}")
           for j, (w, m, c) in enumerate(zip(weights, means, covs))]
    base = base.select(*cx, *ljs)
    lse = _lse([F.col(f"_l{j}") for j in range(k)])
    base = base.select(*cx, *[F.col(f"_l{j}") for j in range(k)], lse.alias("_lse"))
    base = base.select(*cx, "_lse", *[F.exp(F.col(f"_l{j}") - F.col("_lse")).alias(f"_r{j}")
                                      for j in range(k)])
    aggs = [F.sum("_lse").alias("ll"), F.count(F.lit(1)).alias("n")]
    for c in range(k):
        r = F.col(f"_r{c}")
        delta = [cx[i] - _lit(means[c][i]) for i in range(d)]
        aggs.append(F.sum(r).alias(f"n{c}"))
        for i in range(d):
            aggs.append(F.sum(r * delta[i]).alias(f"s{c}_{i}"))
            for j in range(i, d):
                aggs.append(F.sum(r * delta[i] * delta[j]).alias(f"q{c}_{i}_{j}"))
    row = base.agg(*aggs).collect()[0]
    nw, nm, nc = [], [], []
    for c in range(k):
        nk = row[f"n{c}"] or 0.0
        if not row["n"] or nk <= EMPTY * row["n"]:
            nw.append(nk / row["n"] if row["n"] else weights[c])
            nm.append(np.asarray(means[c], dtype=float))
            nc.append(np.asarray(covs[c], dtype=float))
            continue
        step = np.array([row[f"s{c}_{i}"] / nk for i in range(d)])
        cov = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                cov[i, j] = cov[j, i] = row[f"q{c}_{i}_{j}"] / nk - step[i] * step[j]
        nw.append(nk / row["n"])
        nm.append(np.asarray(means[c], dtype=float) + step)
        nc.append(cov)
    return nw, nm, nc, row["ll"]


def loglik_full(df: DataFrame, xs, weights, means, covs) -> float:
    lj = log_joint_cols([x.cast("double") for x in xs], weights, means, covs)
    return df.agg(F.sum(_lse(lj))).collect()[0][0]


def em_fit_full(df: DataFrame, xs, weights, means, covs, max_iter: int, tol: float):
    """EM until the log-likelihood gain is below ``tol`` (or ``max_iter``); returns params and
    the likelihood trace. The data frame should be persisted by the caller."""
    trace = []
    prev = None
    for it in range(max_iter):
        weights, means, covs, ll = em_step_full(df, xs, weights, means, covs)
        trace.append((it, ll))
        if prev is not None and abs(ll - prev) < tol:
            break
        prev = ll
    return weights, means, covs, trace


def em_step_diag(df: DataFrame, vec: str, weights, means, variances, floor: float = 1e-8):
    """One diagonal-covariance EM step on an array column (variances smoothed by a floor): one
    pass, with a weighted vector summary per component."""
    k = len(weights)
    v = F.col(vec)
    lj = log_joint_diag(v, weights, means, variances)
    base = df.select(v.alias("_x"), lj.alias("_lj")).select(
        array_to_vector("_x").alias("_v"), V.log_sum_exp(F.col("_lj")).alias("_lse"),
        responsibilities(F.col("_lj")).alias("_r"))
    stat = Summarizer.metrics("mean", "variance")
    aggs = [F.sum("_lse").alias("ll"), F.count(F.lit(1)).alias("n")]
    for c in range(k):
        r = F.col("_r")[c]
        aggs += [stat.summary(F.col("_v"), F.greatest(r, F.lit(1e-300))).alias(f"c{c}"), F.sum(r).alias(f"n{c}"), F.sum(r * r).alias(f"w{c}")]
    row = base.agg(*aggs).first()
    nw, nm, nv = [], [], []
    for c in range(k):
        nk = row[f"n{c}"] or 0.0
        nw.append(nk / row["n"] if row["n"] else weights[c])
        if not row["n"] or nk <= EMPTY * row["n"]:
            nm.append(np.asarray(means[c], dtype=float))
            nv.append(np.asarray(variances[c], dtype=float))
            continue
        # the summary divides by W - Σr²/W (unbiased); the mixture's variance divides by W
        unbias = (nk - row[f"w{c}"] / nk) / nk
        nm.append(row[f"c{c}"]["mean"].toArray())
        nv.append(np.maximum(row[f"c{c}"]["variance"].toArray() * unbias, floor))
    return nw, nm, nv, row["ll"]
