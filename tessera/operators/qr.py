"""Tall-skinny QR (TSQR) least squares: numerically stable where the Gram is not.

Each task folds its rows into a small R factor (numpy QR on Arrow batches, memory
bounded by one batch plus R); the factors are merged in a few tasks and once more on the
driver. With the target appended as
the last column, R = [[R_xx, z], [0, ρ]] gives the least-squares fit of every leading
column subset (nested models, e.g. polynomial degrees) from the single factorisation:
w = R_xx[:m, :m]⁻¹ z[:m], and ρ² is the residual of the full model.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame


def tsqr_r(df: DataFrame, cols: list[Column]) -> np.ndarray:
    d = len(cols)

    def fold(batches):
        r = None
        for pdf in batches:
            a = pdf.to_numpy(dtype=float)
            if r is not None:
                a = np.vstack([r, a])
            if a.shape[0]:
                r = np.linalg.qr(a, mode="r")
        if r is not None:
            yield pd.DataFrame({"r": [r.ravel().tolist()], "rows": [r.shape[0]]})

    def merge(batches):
        r = None
        for pdf in batches:
            for flat, rows in zip(pdf["r"], pdf["rows"]):
                a = np.array(flat).reshape(rows, d)
                r = np.linalg.qr(a if r is None else np.vstack([r, a]), mode="r")
        if r is not None:
            yield pd.DataFrame({"r": [r.ravel().tolist()], "rows": [r.shape[0]]})

    named = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    schema = "r array<double>, rows int"
    # the factors meet in about as many tasks as the square root of the shuffle partitions first
    tasks = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = named.mapInPandas(fold, schema).repartition(tasks).mapInPandas(merge, schema).collect()
    stack = np.vstack([np.array(p["r"]).reshape(p["rows"], d) for p in parts])
    return np.linalg.qr(stack, mode="r")


def nested_least_squares(R: np.ndarray, m: int) -> np.ndarray:
    """Coefficients of the first ``m`` columns (target = last column of the factored matrix)."""
    z = R[:m, -1]
    w, *_ = np.linalg.lstsq(R[:m, :m], z, rcond=None)
    return w
