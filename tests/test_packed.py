"""Packed sparse rows and what is fitted or searched on them, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import gibbs_lda as LDA
from tessera.operators import gmm as GM
from tessera.operators import logistic as LG
from tessera.operators import packed_gmm as PG
from tessera.operators import packed_kmeans as PK
from tessera.operators import packed_search as PS
from tessera.operators import sparse_kmeans as SK
from tessera.operators import sparse_rows as SR
from tessera.session import forget

ROWS = "id bigint, cols array<int>, vals array<double>, extra double"


def matrix(seed, n, d, density=0.2, unit=False):
    rng = np.random.default_rng(seed)
    m = np.where(rng.random((n, d)) < density, rng.random((n, d)) + 0.1, 0.0)
    m[np.arange(n), rng.integers(d, size=n)] += 0.5
    return m / np.linalg.norm(m, axis=1, keepdims=True) if unit else m


def rows_of(spark, m, extra=None):
    data = [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist(), float(extra[i]) if extra is not None else 0.0) for i, r in enumerate(m)]
    return spark.createDataFrame(data, ROWS).repartition(3)


def test_blocks_and_sums(spark, monkeypatch):
    m = matrix(1, 200, 50)
    blocks = SR.pack(rows_of(spark, m))
    assert blocks.count() == 3

    def add(total, block, w):
        total[0] += block.dot(w).sum()
        np.add.at(total[1:], block.cols, block.vals)
    w = np.arange(50.0)[:, None]
    want = np.concatenate([[(m @ w).sum()], m.sum(axis=0)])
    assert np.allclose(SR.sum_over(blocks, w, (51,), add), want)
    monkeypatch.setattr(SR, "COLLECT_BYTES", 0)         # merged by tasks
    monkeypatch.setattr(SR, "CLOSURE_BYTES", 0)         # broadcast
    assert np.allclose(SR.sum_over(blocks, w, (51,), add), want)
    large = SR.sum_over(blocks, w, (3 * SR.CHUNK + 5,), lambda t, b, w: np.add.at(t, b.cols * (SR.CHUNK // 20), b.vals))
    assert np.allclose(large[np.arange(50) * (SR.CHUNK // 20)], m.sum(axis=0)) and large.sum() == pytest.approx(m.sum())   # several chunks
    blocks.unpersist()


def test_empty_rows_and_tables(spark):
    blocks = SR.pack(spark.createDataFrame([(1, [], [], 0.0), (2, [3], [2.0], 0.0)], ROWS))
    assert np.allclose(SR.sum_over(blocks, np.ones((4, 1)), (1,), lambda t, b, w: t.__iadd__(b.dot(w).sum())), [2.0])
    none = SR.pack(spark.createDataFrame([], ROWS))
    assert np.allclose(SR.sum_over(none, np.ones((4, 1)), (2,), lambda t, b, w: t.__iadd__(1.0)), [0, 0])


def test_tfidf_rows(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "a c"), (3, "a b d"), (4, None), (5, "a")], "id bigint, text string")
    rows, words = SR.tfidf_rows(docs, "id", unit=False)
    number = {r["word"]: r["number"] for r in words.collect()}
    assert sorted(number) == ["a", "b", "c", "d"] and number["a"] == 0      # the most frequent word first
    got = {r["id"]: dict(zip(r["cols"], r["vals"])) for r in rows.collect()}
    assert got[1][number["b"]] == pytest.approx(2 * np.log(5 / 2)) and set(got) == {1, 2, 3, 5}
    unit, _ = SR.tfidf_rows(docs, "id")
    assert all(abs(sum(v * v for v in r["vals"]) - 1) < 1e-12 for r in unit.collect())


def test_packed_kmeans_equals_joined_form(spark):
    m = matrix(2, 120, 40, unit=True)
    rows = rows_of(spark, m)
    k, starts = 4, [[0, 1, 2, 3], [10, 11, 12, 13]]
    blocks = SR.pack(rows)
    runs = [PK.Run(PK.dense(rows, ids, 40)) for ids in starts]
    PK.lloyd(blocks, runs, 50)
    long = rows.select("id", F.explode(F.arrays_zip("cols", "vals")).alias("e")).select("id", F.col("e.cols").cast("string").alias("word"), F.col("e.vals").alias("w"))
    ids = spark.createDataFrame([(r, c, i) for r, s in enumerate(starts) for c, i in enumerate(s)], "run int, k int, id bigint")
    _, members, trace = SK.lloyd(long, SK.start(long, ids), [0, 1], k, 50)
    for r, run in enumerate(runs):
        want = [(it, h, c) for x, it, h, c in trace if x == r]
        assert [(it, c) for it, _, c in run.trace] == [(it, c) for it, _, c in want]
        assert np.allclose([h for _, h, _ in run.trace], [h for _, h, _ in want])
        sizes = {x["cluster"]: x["n"] for x in members.where(F.col("run") == r).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert run.sizes.tolist() == [sizes.get(c, 0) for c in range(k)]
    blocks.unpersist()


def test_runs_in_groups_and_branches(spark, monkeypatch):
    m = matrix(3, 150, 30, unit=True)
    rows = rows_of(spark, m)
    blocks = SR.pack(rows)
    tree = {"": PK.dense(rows, [0, 1], 30)}
    side = ((m[:, None] - m[[0, 1]][None]) ** 2).sum(axis=2).round(9).argmin(axis=1)
    inside = np.flatnonzero(side == 1)
    run, alone = (PK.Run(PK.dense(rows, inside[:2].tolist(), 30), b) for b in ("1", ""))
    monkeypatch.setattr(PK, "MODEL_BYTES", 1)           # every run is a group of its own
    PK.lloyd(blocks, [run, alone], 60, tree)
    PK_only = SR.pack(rows_of(spark, m[inside]))
    want = PK.Run(m[inside[:2]].T.copy())
    PK.lloyd(PK_only, [want], 60)
    assert [c for _, _, c in run.trace] == [c for _, _, c in want.trace] and run.sizes.tolist() == want.sizes.tolist()
    assert alone.sizes.sum() == 150 and not PK.fits(10**9, 5)
    found = {r["id"]: (r["branch"], r["cluster"]) for r in PK.assign(blocks, run.centroids, tree).collect()}
    assert {i for i, (b, _) in found.items() if b == "1"} == set(inside.tolist())
    blocks.unpersist()
    PK_only.unpersist()


def diagonal_em(m, mix):
    joint = np.log(mix.weights) - 0.5 * (np.log(2 * np.pi * mix.variances.T)[None] + (m[:, None] - mix.means.T[None]) ** 2 / mix.variances.T[None]).sum(axis=2)
    top = joint.max(axis=1, keepdims=True)
    lse = top + np.log(np.exp(joint - top).sum(axis=1, keepdims=True))
    r = np.exp(joint - lse)
    n = r.sum(axis=0)
    mean = (r.T @ m / n[:, None]).T
    return n / len(m), mean, np.maximum((r.T @ (m * m) / n[:, None]).T - mean ** 2, 1e-3), lse.sum()


def test_diagonal_em_against_dense(spark):
    m = matrix(4, 90, 12)
    blocks = SR.pack(rows_of(spark, m))
    mix = PG.random_start(12, 3, 5)
    assert (mix.variances >= 1).all() and (mix.variances <= 5).all()
    for _ in range(3):
        w, mean, var, ll = diagonal_em(m, mix)
        mix, got = PG.em_step(blocks, mix, 1e-3)
        assert got == pytest.approx(ll) and np.allclose(mix.weights, w) and np.allclose(mix.means, mean) and np.allclose(mix.variances, var)
    start = PG.from_clusters(blocks, m[:3].T.copy(), 1e-3)
    _, trace = PG.em(blocks, start, 1e-3, 1e-6, 60)
    assert all(b >= a - 1e-6 for a, b in zip(trace, trace[1:-1]))
    blocks.unpersist()


def test_full_em_against_column_form(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0, 1, (60, 2)), rng.normal(4, 0.5, (40, 2))])
    rows = spark.createDataFrame([(i, [0, 1], v.tolist(), 1.0 + i % 2) for i, v in enumerate(x)], ROWS)
    twice = spark.createDataFrame([tuple(map(float, v)) for i, v in enumerate(x) for _ in range(1 + i % 2)], "a double, b double")
    start = [0.5, 0.5], [x[0], x[99]], [np.eye(2), np.eye(2)]
    w, m, c, trace = PG.em_full(SR.pack(rows), *start, 1e-4, 100)
    w2, m2, c2, trace2 = GM.em_fit_full(twice, [F.col("a"), F.col("b")], *start, 100, 1e-4)
    here = SR.summary_block(rows)
    assert isinstance(here, SR.Block) and np.allclose(PG.em_full(here, *start, 1e-4, 100)[3], trace)
    assert not isinstance(SR.summary_block(rows, 99), SR.Block)
    assert len(trace) == len(trace2) < 100 and np.allclose(trace, [ll for _, ll in trace2])
    assert all(b >= a for a, b in zip(trace, trace[1:]))


@pytest.mark.parametrize("density", [0.15, 1.1])
def test_search_settings(spark, monkeypatch, density):
    m = matrix(7, 130, 25, density, unit=True)
    sig = np.random.default_rng(1).integers(0, 256, 130)
    rows = rows_of(spark, m, sig)
    monkeypatch.setattr(PS, "QUERIES", 5)
    monkeypatch.setattr(PS, "EXPANDED", 40)
    settings = [(0, 255, 2), (1, 15, 0), (2, 0, 0)]
    top, n = PS.search(SR.pack(rows), rows.where(F.col("id") % 10 == 0), settings, 4)
    top = {(r["setting"], r["query_id"], r["rank"]): (r["id"], r["distance"]) for r in top.collect()}
    n = {(r["setting"], r["query_id"]): r["n_candidates"] for r in n.collect()}
    for name, mask, radius in settings:
        for q in range(0, 130, 10):
            dist = 1 - m @ m[q]
            ok = np.array([bin((int(s) ^ int(sig[q])) & mask).count("1") <= radius for s in sig]) if mask else (m * (m[q] != 0)).any(axis=1)
            want = sorted((round(float(dist[i]), 9), i) for i in np.flatnonzero(ok))[:4]
            assert n[name, q] == ok.sum()
            assert [top[name, q, r + 1][0] for r in range(len(want))] == [i for _, i in want]
    assert PS.search(SR.pack(rows), rows.where("false"), settings, 4)[0].count() == 0


def test_positions(spark):
    m = matrix(9, 110, 18, 0.3, unit=True)
    rows = rows_of(spark, np.vstack([m, m[:5]]))                # five rows twice: ties by id
    targets = {0: 7, 20: 112, 40: 40, 60: 3}
    got = {r["query_id"]: (r["id"], r["position"]) for r in PS.positions(
        SR.pack(rows), rows.where(F.col("id").isin(list(targets))), spark.createDataFrame(list(targets.items()), "query_id bigint, id bigint")).collect()}
    both = np.vstack([m, m[:5]])
    for q, t in targets.items():
        d = np.round(1 - both @ m[q], 9)
        ok = (both[:, m[q] != 0] != 0).any(axis=1)
        if ok[t]:
            assert got[q] == (t, sum(ok & ((d < d[t]) | ((d == d[t]) & (np.arange(len(d)) < t)))))


def test_sparse_ascent(spark):
    rng = np.random.default_rng(8)
    m = np.hstack([np.ones((80, 1)), matrix(8, 80, 6)])
    y = (rng.random(80) < 0.6).astype(float)
    models = [(0.01, 0.0, 12), (0.02, 1.5, 5)]
    w, ll = LG.sparse_ascent(SR.pack(rows_of(spark, m, y)), 7, models)
    for j, (step, l2, n) in enumerate(models):
        v = np.zeros(7)
        for _ in range(n):
            v = v + step * (m.T @ (y - 1 / (1 + np.exp(-m @ v))) - 2 * l2 * np.r_[0, v[1:]])
        s = m @ v
        assert np.allclose(w[:, j], v) and ll[j] == pytest.approx(((y - 1) * s - np.log1p(np.exp(-s))).sum() - l2 * (v[1:] ** 2).sum())


# ------------------------------------------------------------------ topics

def topic_rows(spark, parts):
    rng = np.random.default_rng(3)
    data = []
    for i in range(90):
        words, n = np.unique(rng.integers(0, 10, 40) + 10 * (i % 3), return_counts=True)
        data.append((i, words.tolist(), n.astype(float).tolist(), 0.0))
    return spark.createDataFrame(data, ROWS).repartition(parts, "id").sortWithinPartitions("id")


def test_gibbs_counts_likelihood_and_topics(spark, monkeypatch):
    monkeypatch.setattr(LDA, "BLOCK_TOKENS", 700)
    settings = [LDA.Setting("a", 0.5, 0.1), LDA.Setting("b", 5.0, 0.5)]
    rows = topic_rows(spark, 2)
    state, counts, trace = LDA.fit(rows, 30, 3, settings, 60, 5, 1)
    assert counts.shape == (2, 30, 3) and (counts >= 0).all()
    assert (counts.sum(axis=(1, 2)) == 90 * 40).all()                       # no token is lost or doubled
    words = np.zeros(30)
    for r in rows.collect():
        words[r["cols"]] += r["vals"]
    assert (counts.sum(axis=2) == words).all()
    assert trace[-1][0] == 60 and all(trace[-1][1][s] > trace[0][1][s] + 100 for s in (0, 1))
    share = LDA.word_shares(counts[0], 0.1)
    assert np.allclose(share.sum(axis=0), 1)
    assert sorted(tuple(sorted(set((np.argsort(-share[:, k])[:10] // 10).tolist()))) for k in range(3)) == [(0,), (1,), (2,)]
    dist = {(r["setting"], r["id"]): r["distribution"] for r in LDA.distributions(state, settings, 3).collect()}
    assert len(dist) == 180 and all(abs(sum(d) - 1) < 1e-9 for d in dist.values())
    mean = {r["id"]: r["distribution"] for r in LDA.average_prediction(state, share, 0.5, 20, 5, 1).collect()}
    assert all(max(d) > 0.8 for d in mean.values())
    again = LDA.fit(rows, 30, 3, settings, 60, 5, 1)
    assert (again[1] == counts).all()                                       # draws follow the keys, not the tasks
    forget(state, again[0])


def test_gibbs_empty_documents(spark):
    rows = spark.createDataFrame([(1, [], [], 0.0), (2, [0, 1], [2.0, 1.0], 0.0)], ROWS)
    state, counts, _ = LDA.fit(rows, 2, 2, [LDA.Setting("a", 1.0, 0.1)], 4, 2, 1)
    assert counts.sum() == 3
    got = {r["id"]: r["distribution"] for r in LDA.distributions(state, [LDA.Setting("a", 1.0, 0.1)], 2).collect()}
    assert got[1] == [0.5, 0.5]
    forget(state)
