"""Golden checks with literal inputs. Inputs and expected numbers are fixed values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import gmm as GM
from tessera.operators import gram as G
from tessera.operators import kmeans as KM
from tessera.operators import logistic as LG
from tessera.operators import tree as T


def test_simple_regression_line(spark):
    df = spark.createDataFrame([(float(x), 1.0 + x) for x in range(5)], "x double, y double")
    g = G.gram(df, {"x": F.col("x")}, "y")[()]
    b0, w = g.ridge(0.0)
    assert b0 == pytest.approx(1.0) and w[0] == pytest.approx(1.0)
    err = F.col("y") - G.predict_expr(b0, w, {"x": F.col("x")})
    assert df.agg(F.sum(err * err)).collect()[0][0] == pytest.approx(0.0, abs=1e-20)


def test_column_norms(spark):
    df = spark.createDataFrame([(3.0, 6.0, 9.0), (4.0, 8.0, 12.0)], "a double, b double, c double")
    r = df.agg(*[F.sqrt(F.sum(F.col(c) * F.col(c))).alias(c) for c in "abc"]).collect()[0]
    assert [r["a"], r["b"], r["c"]] == pytest.approx([5.0, 10.0, 15.0])
    normed = df.select(*[(F.col(c) / r[c]).alias(c) for c in "abc"]).collect()
    assert [x for row in normed for x in row] == pytest.approx([.6, .6, .6, .8, .8, .8])


def test_lasso_coordinate_step():
    X = np.array([[3 / math.sqrt(13), 1 / math.sqrt(10)], [2 / math.sqrt(13), 3 / math.sqrt(10)]])
    y = np.array([1.0, 1.0])
    w = np.array([1.0, 4.0])
    Gm, b = X.T @ X, X.T @ y
    rho = G.lasso_rho(Gm, b, w)[1]
    assert G.soft_threshold(rho, 0.1 / 2) == pytest.approx(0.425558846691, abs=1e-12)


@pytest.mark.parametrize("labels,expected", [([-1, -1, 1, 1, 1], 2), ([-1, -1, 1, 1, 1, 1, 1], 2),
                                             ([-1] * 5 + [1, 1], 2)])
def test_node_mistakes(labels, expected):
    nd = T.Node(1, 0, float(labels.count(1)), float(labels.count(-1)))
    assert nd.mistakes == expected


def test_weighted_mistakes(spark):
    df = spark.createDataFrame([(-1, 1.0, 0), (-1, 2.0, 0), (1, .5, 0), (1, 1.0, 0), (1, 1.0, 0)], "y int, w double, x int")
    tree = T.build_tree(df, ["x"], "y", 1, weight=F.col("w"))     # the split leaves a side empty: one leaf
    assert (tree[1].mistakes, tree[1].prediction, tree[1].feature) == (2.5, -1, None)


def test_logistic_dummy(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, -1), (1.0, -1.0, -1.0, 1)], "a double, b double, c double, y int")
    w = [1.0, 3.0, -1.0]
    xs = [F.col("a"), F.col("b"), F.col("c")]
    scores = [r[0] for r in df.select(LG.margin(w, xs)).collect()]
    assert scores == pytest.approx([4.0, -1.0])
    _, ll = LG.gradient_and_loglik(df, xs, F.col("y"), w)
    expected = sum((ind - 1) * s - math.log(1 + math.exp(-s)) for ind, s in ((0, 4.0), (1, -1.0)))
    assert ll == pytest.approx(expected)


def test_minibatch_gradient(spark):
    df = spark.createDataFrame([(1.0, 2.0, -1.0, 1), (1.0, 0.0, 1.0, -1)], "a double, b double, c double, y int")
    ws, _ = LG.gradient_ascent(df, [F.col("a"), F.col("b"), F.col("c")], F.col("y"), 1.0 / 2, 2)
    assert ws[0.0] == pytest.approx([-0.09755757, 0.68242552, -0.7799831], abs=1e-7)


def test_kmeans_toy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.0],), ([0.0, 0.0, 0.0],), ([2.0, 2.0, 0.0],)], "v array<double>")
    cents = np.array([[.5, .5, 0.], [0., -.5, 0.]])
    a = [r["cluster"] for r in KM.assign(df, "v", cents).collect()]
    assert a == [0, 1, 0]
    assert KM.heterogeneity(df, "v", cents) == pytest.approx(7.25)
    sums = KM.cluster_sums(KM.assign(df, "v", cents), "v", F.col("cluster"))
    new = KM.revise(cents, sums)
    assert new.tolist() == [[1.5, 2.0, 0.0], [0.0, 0.0, 0.0]]


def test_gmm_toy_responsibilities(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, -2.0)], "x double, y double")
    w = [.3, .7]
    m = [np.array([0., 0.]), np.array([1., 1.])]
    c = [np.array([[1.5, 0.], [0., 2.5]]), np.array([[1., 1.], [1., 2.]])]
    lj = GM.log_joint_full([F.col("x"), F.col("y")], w, m, c)
    r = [row[0] for row in df.select(GM.responsibilities(lj)).collect()]
    assert r[0] == pytest.approx([.10512733, .89487267], abs=1e-7)
    assert r[1] == pytest.approx([.46468164, .53531836], abs=1e-7)


def test_gmm_toy_weights(spark):
    df = spark.createDataFrame([(1.0, 2.0), (-1.0, -2.0), (0.0, 0.0)], "x double, y double")
    w = [.3, .7]
    m = [np.array([0., 0.]), np.array([1., 1.])]
    c = [np.array([[1.5, 0.], [0., 2.5]]), np.array([[1., 1.], [1., 2.]])]
    nw, _, _, _ = GM.em_step_full(df, [F.col("x"), F.col("y")], w, m, c)
    assert nw == pytest.approx([.27904866, .72095134], abs=1e-7)


def test_bits_to_integer(spark):
    from tessera.operators import lsh as L
    # a single "vector" whose projections give bits 0,...,0,1,0 (high bit first)
    planes = [[-1.0]] * 14 + [[1.0], [-1.0]]
    df = spark.createDataFrame([([1.0],)], "v array<double>")
    assert df.select(L.signature(F.col("v"), planes)).collect()[0][0] == 2


def test_log_sum_exp_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],)], "z array<double>")
    v = df.select(V.log_sum_exp(F.col("z"))).collect()[0][0]
    assert v == pytest.approx(1000.0 + math.log(2.0))


def test_csv_reader_and_influence_refit(spark, tmp_path):
    """CSV with CR-only line ends and a quoted comma in a header name; refits without chosen
    rows by conditional regression aggregates equal the refits on filtered tables."""
    import duckdb
    rows = duckdb.sql("SELECT p_partkey, p_size, p_retailprice FROM "
                      "read_parquet('/root/testdata/sf0.001/part.parquet') ORDER BY p_partkey").fetchall()
    path = tmp_path / "parts.csv"
    text = '"key","size, units","price"\r' + "".join(f"{k},{s},{p}\r" for k, s, p in rows)
    path.write_bytes(text.encode())
    from tessera.sources.tables import read_csv
    df = read_csv(spark, str(path))
    assert df.count() == len(rows) and df.columns == ["key", "size, units", "price"]
    y = F.when(F.col("`size, units`") != 50, F.col("price"))
    one_pass = df.agg(F.regr_slope(y, "key")).collect()[0][0]
    filtered = df.where(F.col("`size, units`") != 50).agg(F.regr_slope("price", "key")).collect()[0][0]
    assert one_pass == pytest.approx(filtered, rel=1e-12)
