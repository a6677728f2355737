"""Mini-batch stochastic gradient ascent over a table of batches.

Every epoch shuffles the rows by a hash (positions from a distributed row index), cuts them
into contiguous batches and drops the remainder. The batches of all epochs are written once,
as partitions of a table in the shared folder, so that a step reads its own batch by partition
pruning and nothing else. All step sizes advance in the same passes; the log likelihood of a
batch after its update is taken in the pass of the next one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import with_row_index
from tessera.session import written


def batch_table(rows: DataFrame, order: list[Column], salts: list, hash_of, batches: int) -> DataFrame:
    """``rows`` (x array<double>, ind double, and what ``order`` names) in epochs by salt, partitioned
    by step. ``hash_of(salt)`` is the shuffling key of an epoch."""
    size = rows.count() // batches
    out = None
    for e, salt in enumerate(salts):
        at = with_row_index(rows.withColumn("_h", hash_of(salt)), [F.col("_h"), *order], "p")
        part = at.where(F.col("p") < size * batches).select((F.floor(F.col("p") / max(size, 1)) + e * batches).cast("int").alias("step"), "x", "ind")
        out = part if out is None else out.unionByName(part)
    return written(out.repartition("step"), "batches", ("step",))


def _sums(w: np.ndarray, step: int):
    """Per task: rows of this step and gradients by model; rows of the step before and log likelihoods."""
    def run(batches):
        d, models = w.shape
        total = np.zeros(2 + (d + 1) * models)
        for b in batches:
            if b.num_rows == 0:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            ind, now = b.column("ind").to_numpy(), b.column("step").to_numpy() == step
            s = x @ w
            err = ind[:, None] - 1 / (1 + np.exp(-np.clip(s, -700, None)))
            ll = (ind[:, None] - 1) * s - np.where(s < -30, -s, np.log1p(np.exp(-np.maximum(s, -30))))
            total[0] += now.sum()
            total[1] += (~now).sum()
            total[2:2 + models] += ll[~now].sum(axis=0)
            total[2 + models:] += (x[now].T @ err[now]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])
    return run


def ascend(table: DataFrame, d: int, steps: int, step_sizes: list[float]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(step, average log likelihood of its batch after the update, weights) for every step; weights
    (d, step sizes) start at zero and move by size / batch rows times the batch's gradient."""
    w, out = np.zeros((d, len(step_sizes))), []
    sizes = np.array(step_sizes)
    for k in range(steps + 1):
        part = table.where(F.col("step").isin(k - 1, k)).select("x", "ind", "step")      # two partitions
        total = sum((np.array(r["total"]) for r in part.mapInArrow(_sums(w, k), "total array<double>").collect()), np.zeros(2 + (d + 1) * len(sizes)))
        if k:
            out.append((k, total[2:2 + len(sizes)] / max(total[1], 1), w.copy()))
        if total[0]:
            w = w + sizes / total[0] * total[2 + len(sizes):].reshape(d, -1)
    return out
