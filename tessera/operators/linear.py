"""Feature construction helpers for linear models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def poly_columns(x, degree: int) -> list[Column]:
    """[x, x·x, x·x·x, ...] by repeated multiplication (power_1 .. power_degree)."""
    cols, cur = [], _c(x).cast("double")
    for _ in range(degree):
        cols.append(cur)
        cur = cur * _c(x)
    return cols


def feature_array(features: list, constant: bool = True) -> Column:
    """Pack feature columns (plus a leading constant 1) into one array<double>."""
    cols = ([F.lit(1.0)] if constant else []) + [_c(f).cast("double") for f in features]
    return F.array(*cols)
