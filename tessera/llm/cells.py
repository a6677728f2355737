"""All pairs inside buckets, in bounded pieces.

A bucket of up to ``block`` members is one cell. A larger one is dealt into blocks by a hash
of the member, and every pair of blocks is a cell of its own: each pair of members meets in
exactly one cell, no cell holds more than about two blocks, and no pair is ever a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cells_of(key: Column, member: Column, size: Column, block: int) -> Column:
    """Array of (cell, side) of one member of a bucket of ``size``: the cells it takes part in
    and the number of its block."""
    n = F.ceil(size / F.lit(block)).cast("int")
    side = F.pmod(F.xxhash64(member), n.cast("bigint")).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct(
        F.concat_ws(":", key.cast("string"), F.least(side, j).cast("string"), F.greatest(side, j).cast("string")).alias("cell"),
        side.alias("side")))


def dealt(members: DataFrame, payload: DataFrame, member: str) -> DataFrame:
    """``members`` (member, _cells: array of structs with ``cell``) joined with the members'
    payload and dealt out by cell, sorted: one row per member and cell."""
    n = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            2 * members.sparkSession.sparkContext.defaultParallelism)
    rows = payload.join(members, member).select("*", F.inline("_cells")).drop("_cells")
    return rows.repartition(n, "cell").sortWithinPartitions("cell")


def bounds(cell: np.ndarray) -> list[tuple[int, int]]:
    """[lo, hi) of each cell of at least two members in a sorted column of whole cells."""
    cut = np.flatnonzero(cell[1:] != cell[:-1]) + 1
    at = np.concatenate([[0], cut, [len(cell)]])
    return [(int(lo), int(hi)) for lo, hi in zip(at[:-1], at[1:], strict=True) if hi - lo > 1]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` members over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


class Links:
    """What a batch of cells found: for each member with a pair the weight of its partners,
    and the first member of its group in the cell."""

    def __init__(self):
        self.ids, self.weights, self.roots = [], [], []

    def add(self, ids: np.ndarray, weight: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        if len(i) == 0:
            return
        n = np.zeros(len(ids), dtype=np.int64)
        np.add.at(n, i, weight[j])
        np.add.at(n, j, weight[i])
        root = local_roots(len(ids), i, j)
        got = np.flatnonzero(n)
        self.ids.append(ids[got])
        self.weights.append(n[got])
        self.roots.append(ids[root[got]])

    def batch(self) -> pa.RecordBatch | None:
        if not self.ids:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (self.ids, self.weights, self.roots)],
                                          ["member", "linked", "other"])


def lists_of(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the offsets of its rows."""
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    lens = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lens)])
