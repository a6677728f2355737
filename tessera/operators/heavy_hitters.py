"""Frequent items by mergeable counter summaries (Misra-Gries).

A summary keeps at most ``counters`` items. Adding a batch adds its counts; where more items than
counters remain, the (counters + 1)-th largest count is taken from all of them and the items that
reach nothing go. What was taken away in all is the error: an item's true count lies between its
counter and its counter plus the error, and the error is at most N / (counters + 1) of N values,
so every item with more occurrences than that has a counter. Summaries of tasks merge by the
same rule, in as many tasks as the square root of the shuffle partitions, then on the driver; their
size never follows the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "col string, item string, n bigint, error bigint, total bigint"


class Summary:
    """Counters of one column's values."""

    def __init__(self, counters: int):
        self.counters, self.error, self.total = counters, 0, 0
        self.items: dict[str, int] = {}

    def add(self, items: list[str], counts: np.ndarray, error: int, total: int) -> None:
        for i, n in zip(items, counts.tolist()):
            self.items[i] = self.items.get(i, 0) + n
        self.error, self.total = self.error + error, self.total + total
        if len(self.items) > self.counters:
            names, n = list(self.items), np.fromiter(self.items.values(), dtype=np.int64, count=len(self.items))
            cut = int(np.partition(n, len(n) - self.counters - 1)[len(n) - self.counters - 1])
            self.items = {names[i]: int(n[i]) - cut for i in np.flatnonzero(n > cut).tolist()}
            self.error += cut

    def rows(self, col: str) -> pa.RecordBatch:
        """The counters; a first row without item carries the error and the number of values."""
        k = len(self.items)
        return pa.RecordBatch.from_arrays(
            [pa.array([col] * (k + 1)), pa.array([None, *self.items], pa.string()), pa.array([None, *self.items.values()], pa.int64()),
             pa.array([self.error] + [0] * k, pa.int64()), pa.array([self.total] + [0] * k, pa.int64())], ["col", "item", "n", "error", "total"])


def _count(counters: int):
    def run(batches):
        held: dict[str, Summary] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns):
                found = pc.value_counts(column.drop_null())
                values, n = found.field("values").to_pylist(), found.field("counts").to_numpy()
                held.setdefault(name, Summary(counters)).add(values, n, 0, int(n.sum()))
        for name, s in held.items():
            yield s.rows(name)
    return run


def _merged(counters: int, held: dict[str, Summary], t: pa.Table | pa.RecordBatch) -> None:
    for name in pc.unique(t.column("col")).to_pylist():
        mine = t.filter(pc.equal(t.column("col"), name))
        whole = mine.filter(pc.is_null(mine.column("item")))
        some = mine.filter(pc.is_valid(mine.column("item")))
        held.setdefault(name, Summary(counters)).add(some.column("item").to_pylist(), some.column("n").to_numpy(zero_copy_only=False),
                                                     pc.sum(whole.column("error")).as_py() or 0, pc.sum(whole.column("total")).as_py() or 0)


def _merge(counters: int):
    def run(batches):
        held: dict[str, Summary] = {}
        for batch in batches:
            if batch.num_rows:
                _merged(counters, held, batch)
        for name, s in held.items():
            yield s.rows(name)
    return run


def frequent_items(df: DataFrame, counters: int) -> DataFrame:
    """(col, item, lower, upper, total): the items that have a counter, per column of ``df`` (values as
    strings, nulls don't count), with bounds of their number of occurrences."""
    values = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    few = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = values.mapInArrow(_count(counters), SCHEMA).repartition(few).mapInArrow(_merge(counters), SCHEMA).toArrow()
    held: dict[str, Summary] = {}
    if parts.num_rows:
        _merged(counters, held, parts.combine_chunks())
    rows = [(c, i, n, n + s.error, s.total) for c, s in held.items() for i, n in s.items.items()]
    return df.sparkSession.createDataFrame(rows, "col string, item string, lower bigint, upper bigint, total bigint")
