"""Least squares from one aggregation: the Gram (cross-product) statistics.

One Spark aggregation returns, per group, n, Σx, Σxxᵀ, Σxy, Σy, Σy² of the
features shifted by their global means (shift from one cheap first pass keeps
the sums well conditioned and still additive, so fold statistics combine as
train = total − fold). The driver holds only d×d numbers per group and solves
OLS, ridge, gradient descent, lasso coordinate descent and k-fold grids on them;
the data is scanned once, not once per iteration or per feature.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


@dataclass
class Gram:
    names: list[str]
    n: float
    sx: np.ndarray          # (d,)   Σ (x - shift)
    sxx: np.ndarray         # (d,d)  Σ (x - shift)(x - shift)ᵀ
    sxy: np.ndarray         # (d,)   Σ (x - shift)(y - yshift)
    sy: float               # Σ (y - yshift)
    syy: float              # Σ (y - yshift)²
    shift: np.ndarray = field(default=None)
    yshift: float = 0.0

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n - other.n, self.sx - other.sx, self.sxx - other.sxx,
                    self.sxy - other.sxy, self.sy - other.sy, self.syy - other.syy,
                    self.shift, self.yshift)

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n + other.n, self.sx + other.sx, self.sxx + other.sxx,
                    self.sxy + other.sxy, self.sy + other.sy, self.syy + other.syy,
                    self.shift, self.yshift)

    # centred statistics (about this subset's own means)
    def centred(self):
        mx = self.sx / self.n
        my = self.sy / self.n
        cxx = self.sxx - self.n * np.outer(mx, mx)
        cxy = self.sxy - self.n * mx * my
        return mx, my, cxx, cxy

    def ridge(self, l2: float = 0.0, penalise: np.ndarray | None = None):
        """Intercept + weights minimising RSS + l2·‖w‖² (intercept free). l2 = 0 → OLS."""
        mx, my, cxx, cxy = self.centred()
        d = len(self.names)
        pen = np.ones(d) if penalise is None else penalise
        w = np.linalg.solve(cxx + l2 * np.diag(pen), cxy)
        b0 = (my + self.yshift) - float(np.dot(w, mx + self.shift))
        return b0, w

    def raw_system(self):
        """Gram in raw (unshifted) coordinates with a leading constant feature:
        G = [1 x]ᵀ[1 x], b = [1 x]ᵀ y, yy = Σy²."""
        s, ys, n = self.shift, self.yshift, self.n
        sx = self.sx + n * s
        sxx = self.sxx + np.outer(self.sx, s) + np.outer(s, self.sx) + n * np.outer(s, s)
        sy = self.sy + n * ys
        sxy = self.sxy + self.sx * ys + s * self.sy + n * s * ys
        syy = self.syy + 2 * ys * self.sy + n * ys * ys
        d = len(self.names) + 1
        G = np.empty((d, d))
        G[0, 0] = n
        G[0, 1:] = sx
        G[1:, 0] = sx
        G[1:, 1:] = sxx
        b = np.concatenate([[sy], sxy])
        return G, b, syy


def gram(df: DataFrame, features: dict[str, Column], target: Column | str,
         by: list[str] | None = None, shift: bool = True) -> dict:
    """Gram statistics per group (key tuple → Gram); ``by=None`` → key ()."""
    names = list(features)
    xs = {n: _c(e).cast("double") for n, e in features.items()}
    y = _c(target).cast("double")
    base = df.select(*(by or []), *[xs[n].alias(f"_x{i}") for i, n in enumerate(names)],
                     y.alias("_y"))
    d = len(names)
    if shift:
        m = base.agg(*[F.avg(f"_x{i}").alias(f"m{i}") for i in range(d)],
                     F.avg("_y").alias("my")).collect()[0]
        sh = np.array([m[f"m{i}"] or 0.0 for i in range(d)])
        ysh = m["my"] or 0.0
    else:
        sh, ysh = np.zeros(d), 0.0
    xc = [F.col(f"_x{i}") - F.lit(float(sh[i])) for i in range(d)]
    yc = F.col("_y") - F.lit(float(ysh))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yc).alias("sy"), F.sum(yc * yc).alias("syy")]
    for i in range(d):
        aggs.append(F.sum(xc[i]).alias(f"sx{i}"))
        aggs.append(F.sum(xc[i] * yc).alias(f"sxy{i}"))
        for j in range(i, d):
            aggs.append(F.sum(xc[i] * xc[j]).alias(f"sxx{i}_{j}"))
    grouped = base.groupBy(*by).agg(*aggs) if by else base.agg(*aggs)
    out = {}
    for r in grouped.collect():
        sxx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                sxx[i, j] = sxx[j, i] = r[f"sxx{i}_{j}"] or 0.0
        key = tuple(r[b] for b in by) if by else ()
        out[key] = Gram(names, float(r["n"]), np.array([r[f"sx{i}"] or 0.0 for i in range(d)]),
                        sxx, np.array([r[f"sxy{i}"] or 0.0 for i in range(d)]),
                        r["sy"] or 0.0, r["syy"] or 0.0, sh, ysh)
    return out


def total(grams: dict) -> Gram:
    it = iter(grams.values())
    acc = next(it)
    for g in it:
        acc = acc + g
    return acc


def predict_expr(b0: float, w, features: dict[str, Column]) -> Column:
    e = F.lit(float(b0))
    for wi, col in zip(w, features.values()):
        e = e + F.lit(float(wi)) * _c(col)
    return e


# ------------------------------------------------------------------ iterative solvers on G

def gradient_descent(G: np.ndarray, b: np.ndarray, w0: np.ndarray, step: float,
                     tolerance: float, max_iter: int = 100000):
    """w ← w − step·∇RSS with ∇RSS = 2(Gw − b); stop when ‖∇‖ < tolerance.
    Same iterates as the row-wise loop (errors = Xw − y, ∇ = 2Xᵀerrors)."""
    w = w0.astype(float).copy()
    it = 0
    while it < max_iter:
        grad = 2.0 * (G @ w - b)
        if np.sqrt(grad @ grad) < tolerance:
            break
        w = w - step * grad
        it += 1
    return w, it


def ridge_gradient_descent(G: np.ndarray, b: np.ndarray, w0: np.ndarray, step: float,
                           l2: float, passes: int):
    """Fixed passes of w_j ← w_j − step·(2(Gw − b)_j + 2·l2·w_j), constant (j=0) not penalised."""
    w = w0.astype(float).copy()
    pen = np.ones_like(w)
    pen[0] = 0.0
    for _ in range(passes):
        grad = 2.0 * (G @ w - b) + 2.0 * l2 * pen * w
        w = w - step * grad
    return w


def lasso_rho(G: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """ρ_i = Σ x_i (y − ŷ + w_i x_i) = b_i − (Gw)_i + G_ii w_i."""
    return b - G @ w + np.diag(G) * w


def soft_threshold(x: float, by: float) -> float:
    """``x`` moved towards zero by ``by``, and zero where it would cross."""
    return x - by if x > by else (x + by if x < -by else 0.0)


def lasso_coordinate_descent(G: np.ndarray, b: np.ndarray, w0: np.ndarray, l1: float,
                             tolerance: float, max_cycles: int = 10000):
    """Cyclical coordinate descent on normalised features (G_ii = 1), covariance updates.
    Coordinate 0 (constant) is not penalised. Stop when the sum of the changes in one
    full cycle is below ``tolerance``."""
    w = w0.astype(float).copy()
    cycles = 0
    while cycles < max_cycles:
        change = 0.0
        for i in range(len(w)):
            rho = b[i] - G[i] @ w + G[i, i] * w[i]
            new = rho if i == 0 else soft_threshold(rho, l1 / 2.0)
            change += abs(new - w[i])
            w[i] = new
        cycles += 1
        if change < tolerance:
            break
    return w, cycles
