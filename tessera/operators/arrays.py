"""Sums of numpy arrays made in tasks, without one row per element and without handing every
task's array to the driver."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "part int, sums binary"


def packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Rows (part, sums) of a task's arrays of doubles."""
    return pa.RecordBatch.from_arrays(
        [pa.array(list(parts), type=pa.int32()), pa.array([np.asarray(v, dtype=np.float64).tobytes() for v in parts.values()],
                                                          type=pa.binary())], ["part", "sums"])


def sum_arrays(rows: DataFrame, small: bool = False) -> dict[int, np.ndarray]:
    """Sum of ``sums`` by ``part``: first in about as many tasks as the square root of the
    shuffle partitions, then on the driver, a task's arrays at a time; all tasks' arrays in one
    job where the caller knows that together they are ``small``."""
    if small:
        got, out = rows.toArrow(), {}
        for c, s in zip(got.column("part").to_pylist(), got.column("sums").to_pylist()):
            x = np.frombuffer(s, dtype=np.float64)
            out[c] = out[c] + x if c in out else x
        return out

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, s in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
                x = np.frombuffer(s, dtype=np.float64)
                total[c] = total[c] + x if c in total else x.copy()
        if total:
            yield packed(total)

    tasks = max(1, math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out: dict[int, np.ndarray] = {}
    for r in rows.repartition(tasks).mapInArrow(add, SCHEMA).toLocalIterator():
        x = np.frombuffer(bytes(r["sums"]), dtype=np.float64)
        out[r["part"]] = out[r["part"]] + x if r["part"] in out else x
    return out
