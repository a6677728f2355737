"""Operators whose form changed for scale or correctness: against brute force on small data."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import block_search, gmm, neighbors, relational, sparse_kmeans, split, tree
from tessera.sources.tables import read_word_list
from tessera.streaming import online


def test_undersample_reduces_the_largest_class_only(spark):
    rows = [(i, "a" if i < 100 else "b" if i < 300 else "c") for i in range(1000)] + [(2000, None)]
    got = {r["y"]: r["count"] for r in split.undersample_majority(
        spark.createDataFrame(rows, "k int, y string"), "k", "y", 3).groupBy("y").count().collect()}
    assert got["a"] == 100 and got["b"] == 200 and got[None] == 1 and 60 < got["c"] < 145
    one = spark.createDataFrame(rows[:50], "k int, y string")
    assert split.undersample_majority(one, "k", "y", 3).count() == 50
    assert split.undersample_majority(one.where("false"), "k", "y", 3).count() == 0


@pytest.mark.parametrize("block", [4, 7, 1 << 16])
def test_rolling_mean_keeps_its_digits(spark, block):
    v = [1e12 if i < 20 else i * 0.25 for i in range(60)]
    df = spark.createDataFrame(list(enumerate(v)), "k int, v double").repartition(5)
    got = {r["k"]: r["m"] for r in relational.rolling_mean(df, [F.col("k")], "v", 4, "m", block).collect()}
    assert got == {i: pytest.approx(sum(v[i - 3:i + 1]) / 4, rel=1e-15) for i in range(3, 60)}
    assert relational.rolling_mean(df.where("k < 3"), [F.col("k")], "v", 4, "m", block).count() == 0


def test_online_model_is_found_by_uri(spark, tmp_path):
    path = str(tmp_path / "model")
    assert online._latest_weights(spark, path, 5, 3).tolist() == [0, 0, 0]
    (spark.createDataFrame([(1, i, float(i + 1)) for i in range(3)], "batch_id bigint, index bigint, weight double")
     .write.partitionBy("batch_id").parquet(path))
    for where in (path, "file:" + path, "file://" + path):
        assert online._latest_weights(spark, where, 5, 3).tolist() == [1, 2, 3]
        assert online._latest_weights(spark, where, 1, 3).tolist() == [0, 0, 0]


def test_cluster_session_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_word_list(spark, tmp_path):
    (tmp_path / "words.json").write_text(json.dumps(["good", "bad", "good"]))
    assert sorted(r["word"] for r in read_word_list(spark, str(tmp_path / "words.json")).collect()) == ["bad", "good"]


def test_mixture_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (300, 2)), rng.normal(5, 0.5, (200, 2))])
    start = [.5, .5], [np.zeros(2), np.full(2, 4.0)], [np.eye(2), np.eye(2)]
    xs = [F.col("a"), F.col("b")]
    at = {}
    for shift in (0.0, 1e8):
        df = spark.createDataFrame([(float(a + shift), float(b + shift)) for a, b in x], "a double, b double")
        w, m, c, _ = gmm.em_step_full(df, xs, start[0], [v + shift for v in start[1]], start[2])
        at[shift] = w, [v - shift for v in m], c
    assert np.allclose(at[0.0][0], at[1e8][0], atol=1e-6)
    assert np.allclose(at[0.0][2], at[1e8][2], atol=1e-4) and all(np.linalg.det(c) > 0 for c in at[1e8][2])


def test_mixture_keeps_an_empty_component(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "a double")
    w, m, c, _ = gmm.em_step_full(df, [F.col("a")], [.5, .5], [np.zeros(1), np.full(1, 1e6)], [np.eye(1), np.eye(1)])
    assert w[1] < 1e-12 and m[1].tolist() == [1e6]
    gmm.em_step_full(df, [F.col("a")], w, m, c)
    v = df.select(F.array("a").alias("v"))
    w, m, s, _ = gmm.em_step_diag(v, "v", [.5, .5], [np.zeros(1), np.full(1, 1e6)], [np.ones(1), np.ones(1)])
    assert m[0][0] == pytest.approx(0.5) and s[0][0] == pytest.approx(0.25) and m[1].tolist() == [1e6]


def test_deep_tree_predicts(spark):
    names = [f"x{i}" for i in range(9)]
    rows = [tuple((n >> i) & 1 for i in range(9)) + (1 if bin(n).count("1") % 2 else -1,) for n in range(512)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names) + ", y int")
    nodes = {1: tree.Node(1, 0, 256, 256)}
    for k in range(1, 512):          # the parity of nine bits: a full tree
        nodes[k] = tree.Node(k, k.bit_length() - 1, 1, 1, feature=k.bit_length() - 1)
    for k in range(512, 1024):
        nodes[k] = tree.Node(k, 9, 1, 1, prediction=1 if bin(k - 512).count("1") % 2 else -1)
    assert df.where(tree.predict_column(nodes, names) != F.col("y")).count() == 0


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_block_search_against_brute_force(spark, metric):
    rng = np.random.default_rng(4)
    x, q = np.round(rng.normal(size=(90, 3)), 1), np.round(rng.normal(size=(11, 3)), 1)
    corpus = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "row int, label int, vec array<double>").repartition(4)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id int, vec array<double>")

    def dist(a, b):
        if metric == "euclidean":
            return round(float(np.sqrt(((a - b) ** 2).sum())), 9)
        return round(float(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9)
    want = {(i, k + 1): r for i in range(11) for k, (_, r) in enumerate(sorted((dist(q[i], x[r]), r) for r in range(90))[:5])}
    for block in (4, 100):
        got = block_search.search(corpus, queries, 5, metric, block=block).collect()
        assert {(r["query_id"], r["rank"]): r["row"] for r in got} == want
    near = block_search.search(corpus, queries, 1, metric, by_class=True, block=4).collect()
    assert {(r["query_id"], r["label"]): r["row"] for r in near} == {
        (i, c): min((dist(q[i], x[r]), r) for r in range(c, 90, 3))[1] for i in range(11) for c in range(3)}
    assert block_search.search(corpus, queries.where("false"), 5).count() == 0
    assert block_search.search(corpus.where("false"), queries, 5).count() == 0


def test_dense_knn_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    corpus = spark.createDataFrame([(i, rng.normal(size=2).tolist()) for i in range(40)], "id int, v array<double>")
    queries = spark.createDataFrame([(i, rng.normal(size=2).tolist()) for i in range(9)], "q int, v array<double>")
    whole = sorted(map(tuple, neighbors.dense_knn(corpus, "id", "v", queries, "q", "v", 3).collect()))
    monkeypatch.setattr(neighbors, "MAX_DENSE_QUERIES", 4)
    assert sorted(map(tuple, neighbors.dense_knn(corpus, "id", "v", queries, "q", "v", 3).collect())) == whole


def test_sparse_kmeans_against_dense(spark):
    rng = np.random.default_rng(6)
    x = rng.random((40, 6)) * (rng.random((40, 6)) < 0.6)
    x = x[x.sum(axis=1) > 0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, f"w{j}", float(v)) for i, r in enumerate(x) for j, v in enumerate(r) if v], "id int, word string, w double")
    rows = sparse_kmeans.unit_rows(df, "id", "w")
    first = spark.createDataFrame([(r, k, k + 3 * r) for r in (0, 1) for k in range(3)], "run int, k int, id int")
    _, members, trace = sparse_kmeans.lloyd(rows, sparse_kmeans.start(rows, first), [0, 1], 3, 50)
    rows.unpersist()
    for run in (0, 1):
        c, old, n = x[[3 * run, 3 * run + 1, 3 * run + 2]], None, 0
        while True:
            near = np.round(((x[:, None] - c[None]) ** 2).sum(axis=2), 9).argmin(axis=1)
            if old is not None and (near == old).all():
                break
            c = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(3)])
            old, n = near, n + 1
        got = {r["id"]: r["cluster"] for r in members.where(F.col("run") == run).collect()}
        assert [got[i] for i in range(len(x))] == near.tolist()
        mine = [t for t in trace if t[0] == run]
        assert len(mine) == n
        assert mine[-1][2] == pytest.approx(((x - c[near]) ** 2).sum(), abs=1e-9) and not math.isnan(mine[-1][2])
