"""Dense vector math on array columns with Catalyst higher-order functions.

Vectors are ``array<double|float>`` columns; models (centroids, query points,
weights) are small driver-side lists embedded as literals, so every row is
scored in one projection without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lit_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0),
                              lambda acc, v: acc + v))


def sq_euclidean(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def euclidean(a, b) -> Column:
    return F.sqrt(sq_euclidean(a, b))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def sub(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def mul(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def div(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x / y)


def scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x * s)


def power(a, p: float) -> Column:
    return F.transform(_c(a), lambda x: F.pow(x, F.lit(float(p))))


def l2_normalize(a) -> Column:
    n = norm(a)
    return F.transform(_c(a), lambda x: x / n)


def to_double(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def log_sum_exp(a) -> Column:
    """Stable log(sum(exp(z))) of an array: m + log(sum(exp(z - m)))."""
    m = F.array_max(_c(a))
    return m + F.log(F.aggregate(F.transform(_c(a), lambda z: F.exp(z - m)), F.lit(0.0),
                                 lambda acc, v: acc + v))


# ---- batched dense math against a small literal matrix (centroids, query points, planes).
# Arrow batches + numpy: one vectorised pass per batch instead of per-element lambdas.
# Sums run over the dimensions in order (0.0 + t0 + t1 + ...), exactly as the array forms.

def _stack(s):
    return np.stack(s.to_numpy()).astype(float) if len(s) else np.zeros((0, 0))


def sq_dists_to(vec, points) -> Column:
    """array<double>: squared Euclidean distance of each row vector to every literal point."""
    P = np.asarray(points, dtype=float)

    @F.pandas_udf("array<double>")
    def f(s: pd.Series) -> pd.Series:
        X = _stack(s)
        acc = np.zeros((X.shape[0], P.shape[0]))
        for i in range(P.shape[1]):
            t = X[:, i, None] - P[None, :, i]
            acc = acc + t * t
        return pd.Series(list(acc))
    return f(_c(vec))


def dots_to(vec, points) -> Column:
    """array<double>: dot product of each row vector with every literal point."""
    P = np.asarray(points, dtype=float)

    @F.pandas_udf("array<double>")
    def f(s: pd.Series) -> pd.Series:
        X = _stack(s)
        acc = np.zeros((X.shape[0], P.shape[0]))
        for i in range(P.shape[1]):
            acc = acc + X[:, i, None] * P[None, :, i]
        return pd.Series(list(acc))
    return f(_c(vec))


def seq_norm(v) -> float:
    import math
    acc = 0.0
    for x in v:
        acc = acc + float(x) * float(x)
    return math.sqrt(acc)
