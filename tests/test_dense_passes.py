"""Dense k-means passes: nearest centroids by a matrix product, differences only for near ties."""

import numpy as np
import pytest

from tessera.operators import kmeans as KM


def test_nearest_differences_only_for_ties(monkeypatch):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(500, 16)) + 100, rng.normal(size=(5, 16)) + 100
    c[3] = c[1]                                                 # a tie of every row near it
    x[7] = (c[0] + c[2]) / 2
    x[9, 0] = np.nan
    want, seen, plain = KM._squared(x, c).argmin(axis=1), [], KM._squared
    monkeypatch.setattr(KM, "_squared", lambda x, c: seen.append(len(x)) or plain(x, c))
    got = KM._nearest_of(x, (x * x).sum(axis=1), c)
    assert got.tolist() == want.tolist() and 0 < sum(seen) < 500    # before: every row


def test_passes_take_one_job(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(m, 1, (60, 3)) for m in (0, 4, 8)])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, v array<double>").repartition(5)
    calls, plain = [], KM.sum_arrays
    monkeypatch.setattr(KM, "sum_arrays", lambda rows, small=False: calls.append(small) or plain(rows, small))
    runs = KM.lloyd_runs(df, "v", {1: x[[0, 60, 120]], 2: x[[0, 1, 2]]}, 100)
    assert calls and all(calls)
    monkeypatch.setattr(KM, "COLLECT_BYTES", 0)                 # merged by tasks
    again = KM.lloyd_runs(df, "v", {1: x[[0, 60, 120]], 2: x[[0, 1, 2]]}, 100)
    for r, first in ((1, x[[0, 60, 120]]), (2, x[[0, 1, 2]])):
        c, old, steps = first, None, 0
        while True:
            near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            if old is not None and (near == old).all():
                break
            c, old, steps = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(3)]), near, steps + 1
        for found in (runs, again):
            assert np.allclose(found[r][0], c) and len(found[r][1]) == steps
            assert found[r][1][-1][1] == pytest.approx(((x - c[near]) ** 2).sum())
