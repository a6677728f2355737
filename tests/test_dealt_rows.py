"""Rows of fits of many passes: dealt evenly; dense products give what sparse ones give."""

import numpy as np

from tessera.operators import logistic as LG
from tessera.operators import sparse_rows as SR

ROWS = "id bigint, cols array<int>, vals array<double>, extra double"


def block(n=40, d=6, seed=2):
    rng = np.random.default_rng(seed)
    m = rng.integers(0, 3, (n, d)) * (rng.random((n, d)) < 0.6)
    row, col = np.nonzero(m)
    at = np.searchsorted(row, np.arange(n + 1))
    return SR.Block(np.arange(n), at, col.astype(np.int32), m[row, col].astype(float), rng.integers(0, 2, n).astype(float)), m


def test_dense_gradient_is_the_sparse_one(monkeypatch):
    b, m = block()
    assert (b.table(6) == m).all()
    w, dense, sparse = np.random.default_rng(1).normal(size=(6, 3)), np.zeros((7, 3)), np.zeros((7, 3))
    LG._add_gradient(dense, b, w)
    monkeypatch.setattr(SR, "DENSE", 0)
    assert b.table(6) is None
    LG._add_gradient(sparse, b, w)
    assert np.allclose(dense, sparse, rtol=1e-12, atol=1e-12)


def test_rows_are_dealt_to_the_cores(spark):
    data = [(i, [0, 1], [1.0, 2.0], 0.0) for i in range(400)]
    cores = spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame(data, ROWS).repartition(3 * cores + 1)
    sizes = SR.dealt(rows).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == cores and sum(sizes) == 400 and max(sizes) <= 2 * 400 / cores
    assert SR.dealt(rows.where("false")).count() == 0
