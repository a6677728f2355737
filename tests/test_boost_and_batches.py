"""Boosting on counted rows, frequent items, mini-batches and recommendations for all users."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import hash32
from tessera.operators import binned_boost as BB
from tessera.operators import heavy_hitters as HH
from tessera.operators import minibatch as MB
from tessera.operators import recommend as RC
from tessera.session import forget


def boost_rows(spark):
    rng = np.random.default_rng(4)
    a, b, c = rng.integers(0, 5, 400), rng.integers(0, 2, 400), rng.integers(0, 3, 400)
    y = ((a > 2) ^ (b == 1) ^ (rng.random(400) < 0.1)).astype(int)
    data = [tuple(map(int, r)) for r in zip(a, b, c, y, rng.random(400) < 0.3)]
    return np.array(data), spark.createDataFrame(data, "a int, b int, c int, y int, test int").repartition(3)


def test_boost_same_on_the_cluster(spark, monkeypatch):
    data, df = boost_rows(spark)
    monkeypatch.setattr(BB, "REWRITE", 2)
    here = BB.binned(df, ["a", "b", "c"], [5, 2, 3], "y", "test")
    there = BB.binned(df, ["a", "b", "c"], [5, 2, 3], "y", "test", local_rows=0)
    assert here.block is not None and there.block is None
    trees, errors = BB.boost(here, 5, 2)
    trees2, errors2 = BB.boost(there, 5, 2)
    assert np.allclose(np.array(errors), np.array(errors2))
    for t, u in zip(trees, trees2):
        assert (t.feature == u.feature).all() and (t.cut == u.cut).all() and np.allclose(t.value, u.value)
    there.close()
    x, y, test = data[:, :3], data[:, 3], data[:, 4]
    margin = np.zeros(len(y))
    for i, t in enumerate(trees):
        margin += t.value[t.node(x)]
        assert errors[i + 1][0] == pytest.approx(((margin > 0) != (y == 1))[test == 0].mean())
        assert errors[i + 1][1] == pytest.approx(((margin > 0) != (y == 1))[test == 1].mean())
    assert errors[5][0] < errors[1][0] + 1e-9


def test_first_tree_against_brute_force(spark):
    data, df = boost_rows(spark)
    (tree,), _ = BB.boost(BB.binned(df, ["a", "b", "c"], [5, 2, 3], "y", "test"), 1, 1)
    x, y = data[data[:, 4] == 0, :3], data[data[:, 4] == 0, 3]
    g, h = 0.5 - y, np.full(len(y), 0.25)
    gains = {}
    for f in range(3):
        for t in range(x[:, f].max()):
            left = x[:, f] <= t
            gains[f, t] = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)
    best = max(gains, key=lambda k: (round(gains[k], 12), -k[0], -k[1]))
    assert (tree.feature[1], tree.cut[1]) == best
    left = x[:, best[0]] <= best[1]
    assert tree.value[2] == pytest.approx(-0.3 * g[left].sum() / (h[left].sum() + 1))


def test_frequent_items_bounds(spark):
    rng = np.random.default_rng(5)
    words = [f"w{min(int(z), 400)}" for z in rng.zipf(1.4, 6000)] + [None] * 50
    df = spark.createDataFrame([(w, i % 7) for i, w in enumerate(words)], "w string, n int").repartition(5)
    true = collections.Counter(w for w in words if w is not None)
    for counters in (3, 20, 1000):
        got = {r["item"]: r for r in HH.frequent_items(df.select("w"), counters).collect()}
        assert len(got) <= counters
        for item, r in got.items():
            assert r["lower"] <= true[item] <= r["upper"] and r["upper"] - r["lower"] <= 6000 / (counters + 1) and r["total"] == 6000
        assert {w for w, n in true.items() if n > 6000 / (counters + 1)} <= set(got)
    assert {r["item"]: r["lower"] for r in HH.frequent_items(df.select("n"), 10).collect()} == {
        str(k): v for k, v in collections.Counter(i % 7 for i in range(len(words))).items()}
    assert HH.frequent_items(df.where("false"), 5).count() == 0


def test_minibatch_reads_its_partition_only(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(230, 2))
    y = (rng.random(230) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    rows = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id bigint, x array<double>, ind double")
    table = MB.batch_table(rows, [F.col("id")], [1, 2], lambda salt: hash32("id", salt), 10)
    sizes = {r["step"]: r["count"] for r in table.groupBy("step").count().collect()}
    assert sizes == {s: 23 for s in range(20)}
    plan = table.where(F.col("step").isin(3, 4))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [step" in plan
    out = MB.ascend(table, 2, 20, [0.5, 2.0])
    batch = {s: ([], []) for s in range(20)}
    for r in table.collect():
        batch[r["step"]][0].append(r["x"])
        batch[r["step"]][1].append(r["ind"])
    for j, size in enumerate((0.5, 2.0)):
        w = np.zeros(2)
        for s in range(20):
            bx, by = map(np.array, batch[s])
            w = w + size / len(by) * bx.T @ (by - 1 / (1 + np.exp(-bx @ w)))
            m = bx @ w
            assert np.allclose(out[s][2][:, j], w) and out[s][1][j] == pytest.approx(((by - 1) * m - np.log1p(np.exp(-m))).mean())
    forget(table)


@pytest.mark.parametrize("pairs,history", [(1 << 21, 1 << 19), (50, 20)])
def test_recommend_all_users(spark, monkeypatch, pairs, history):
    monkeypatch.setattr(RC, "PAIRS", pairs)
    monkeypatch.setattr(RC, "HISTORY", history)
    rng = np.random.default_rng(7)
    data = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 40, 300), rng.integers(0, 30, 300))}) + [(99, 1000)]
    inter = spark.createDataFrame(data, "user bigint, item bigint")
    want = {tuple(r)[:3]: r["score"] for r in RC.item_similarity_recommend(inter, inter.select("user").distinct(), 4).collect()}
    got = {tuple(r)[:3]: r["score"] for r in RC.item_recommend_all(inter, 4).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in got)
