"""Regression queries on the Gram.

Fixtures (fixed values):
  part:     x = p_size / 50, y = p_retailprice; split: md5(p_partkey:1) % 1000 < 800 → train
  lineitem: y = 50 + 3·l_quantity − 200·l_discount + (cents % 100) / 10, features l_quantity,
            l_discount, l_tax; row key (l_orderkey:l_linenumber:l_partkey:l_suppkey:cents:qty);
            split: md5(rowkey:1) % 1000 < 800 → train
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators import gram as G
from tessera.operators.linear import poly_columns
from tessera.operators.split import kfold_assign
from tessera.plans.sqlbits import ols_ctes
from tessera.registry import query
from tessera.sources.tables import Tables

LI_FEATURES = ["qty", "disc", "tax"]


def li_frame(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    li = li.withColumn("cents", cents)
    rowkey = F.concat_ws(":", *[F.col(c).cast("string") for c in
                                ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents")],
                         F.col("l_quantity").cast("bigint").cast("string"))
    y = 50 + 3 * F.col("l_quantity") - 200 * F.col("l_discount") + (F.col("cents") % 100) / 10.0
    return li.select(rowkey.alias("rowkey"), F.col("l_quantity").alias("qty"),
                     F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"), y.alias("y"),
                     F.when(bucket(rowkey, 1) < 800, "train").otherwise("test").alias("split"))


LI_SQL = f"""li AS (
  SELECT rowkey, l_quantity AS qty, l_discount AS disc, l_tax AS tax,
         50 + 3 * l_quantity - 200 * l_discount + (cents % 100) / 10.0 AS y,
         CASE WHEN {sql_hash32('rowkey', 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents,
                            l_quantity::BIGINT) AS rowkey
        FROM (SELECT *, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem)))"""


def part_frame(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", (F.col("p_size") / 50.0).alias("x"),
                    F.col("p_retailprice").alias("y"), "p_size",
                    F.when(bucket("p_partkey", 1) < 800, "train").otherwise("test").alias("split"))


PT_SQL = f"""pt AS (
  SELECT p_partkey, p_size / 50.0 AS x, p_retailprice AS y, p_size,
         CASE WHEN {sql_hash32('p_partkey', 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split
  FROM part)"""


def _coef_sql(names: list[str], src: str = "ols") -> str:
    parts = ["SELECT '(intercept)' AS name, 0::BIGINT AS index, round(b0, 6) AS value FROM " + src]
    for i, n in enumerate(names, 1):
        parts.append(f"SELECT '{n}', {i}::BIGINT, round(b{i}, 6) FROM {src}")
    return "\nUNION ALL ".join(parts)


def _coef_df(spark, names, b0, w):
    rows = [("(intercept)", 0, round(float(b0), 6))] + [
        (n, i + 1, round(float(v), 6)) for i, (n, v) in enumerate(zip(names, w))]
    return spark.createDataFrame(rows, "name string, index bigint, value double")


# ------------------------------------------------------------------ simple regression

@query("simple_regression", rows=("R1",), oracle="""
SELECT round(regr_intercept(p_retailprice, p_partkey), 6) AS intercept,
       round(regr_slope(p_retailprice, p_partkey), 9) AS slope FROM part
""")
def simple_regression(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.agg(F.round(F.regr_intercept("p_retailprice", "p_partkey"), 6).alias("intercept"),
                 F.round(F.regr_slope("p_retailprice", "p_partkey"), 9).alias("slope"))


def _simple_model(df, y, x):
    r = df.agg(F.regr_intercept(y, x).alias("b0"), F.regr_slope(y, x).alias("b1")).collect()[0]
    return r["b0"], r["b1"]


@query("inverse_prediction", rows=("R2",), oracle="""
WITH m AS (SELECT regr_intercept(p_retailprice, p_partkey) AS b0,
                  regr_slope(p_retailprice, p_partkey) AS b1 FROM part)
SELECT p_partkey, round(b0 + b1 * p_partkey, 4) AS predicted,
       round((p_retailprice - b0) / b1, 2) AS inverse_key FROM part, m
""")
def inverse_prediction(spark, sf_dir):
    """Predicted price of every part; inverse: the key at which the model predicts its price."""
    p = Tables(spark, sf_dir).part
    b0, b1 = _simple_model(p, "p_retailprice", "p_partkey")
    return p.select("p_partkey", F.round(F.lit(b0) + F.lit(b1) * F.col("p_partkey"), 4)
                    .alias("predicted"),
                    F.round((F.col("p_retailprice") - F.lit(b0)) / F.lit(b1), 2)
                    .alias("inverse_key"))


@query("rss", rows=("R3",), oracle=f"""
WITH {PT_SQL},
m AS (SELECT regr_intercept(y, x) AS b0, regr_slope(y, x) AS b1 FROM pt WHERE split = 'train')
SELECT split, round(sum((y - (b0 + b1 * x)) ^ 2), 3) AS rss, count(*)::BIGINT AS n FROM pt, m GROUP BY split
""")
def rss(spark, sf_dir):
    """Fit on train, residual sum of squares on train and test in one pass."""
    p = part_frame(spark, sf_dir)
    b0, b1 = _simple_model(p.where(F.col("split") == "train"), "y", "x")
    err = F.col("y") - (F.lit(b0) + F.lit(b1) * F.col("x"))
    return p.groupBy("split").agg(F.round(F.sum(err * err), 3).alias("rss"),
                                  F.count(F.lit(1)).alias("n"))


@query("influence_refit", rows=("R25",), oracle="""
SELECT 'all' AS scenario, round(regr_slope(p_retailprice, p_partkey), 9) AS slope,
       round(regr_intercept(p_retailprice, p_partkey), 6) AS intercept FROM part
UNION ALL
SELECT 'without_size_50', round(regr_slope(p_retailprice, p_partkey), 9),
       round(regr_intercept(p_retailprice, p_partkey), 6) FROM part WHERE p_size <> 50
UNION ALL
SELECT 'price_below_990', round(regr_slope(p_retailprice, p_partkey), 9),
       round(regr_intercept(p_retailprice, p_partkey), 6) FROM part WHERE p_retailprice < 990
""")
def influence_refit(spark, sf_dir):
    """Refits without chosen outliers, all in one pass (conditional regression aggregates)."""
    p = Tables(spark, sf_dir).part
    scen = {"all": F.lit(True), "without_size_50": F.col("p_size") != 50,
            "price_below_990": F.col("p_retailprice") < 990}
    aggs = []
    for name, cond in scen.items():
        y = F.when(cond, F.col("p_retailprice"))
        aggs += [F.regr_slope(y, "p_partkey").alias(f"{name}_s"),
                 F.regr_intercept(y, "p_partkey").alias(f"{name}_i")]
    wide = p.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("scenario"), F.round(F.col(f"{n}_s"), 9).alias("slope"),
                 F.round(F.col(f"{n}_i"), 6).alias("intercept")) for n in scen])).alias("s")) \
        .select("s.*")


# ------------------------------------------------------------------ multiple regression

@query("linreg_multi", rows=("R4", "R5"), oracle=f"""
WITH {LI_SQL},
{ols_ctes('li', LI_FEATURES, 'y')}
{_coef_sql(LI_FEATURES)}
""")
def linreg_multi(spark, sf_dir):
    """OLS by feature-name list; coefficient table (name, index, value) from one Gram."""
    li = li_frame(spark, sf_dir)
    g = G.gram(li, {f: F.col(f) for f in LI_FEATURES}, "y")[()]
    b0, w = g.ridge(0.0)
    return _coef_df(spark, LI_FEATURES, b0, w)


def _subset_gram(g: G.Gram, idx: list[int]) -> G.Gram:
    ix = np.array(idx)
    return G.Gram([g.names[i] for i in idx], g.n, g.sx[ix], g.sxx[np.ix_(ix, ix)], g.sxy[ix],
                  g.sy, g.syy, g.shift[ix], g.yshift)


MODELS = {1: ["qty"], 2: ["qty", "disc"], 3: ["qty", "disc", "tax"]}


def _compare_sql():
    ctes, preds = [], []
    for m, feats in MODELS.items():
        ctes.append(ols_ctes("li WHERE split = 'train'", feats, "y", prefix=f"m{m}"))
        pred = f"m{m}.b0 + " + " + ".join(f"m{m}.b{i} * {f}" for i, f in enumerate(feats, 1))
        preds.append(f"SELECT {m}::BIGINT AS model, split, y - ({pred}) AS err FROM li, m{m}")
    return (f"WITH {LI_SQL},\n" + ",\n".join(ctes) + ",\nerrs AS (" + "\nUNION ALL ".join(preds)
            + ")\nSELECT model, split, round(sum(err * err), 2) AS rss, "
              "round(sqrt(avg(err * err)), 6) AS rmse FROM errs GROUP BY model, split")


@query("compare_models", rows=("R6", "R26"), oracle=_compare_sql())
def compare_models(spark, sf_dir):
    """Nested models fitted on train from one Gram of the widest set; RSS and RMSE of all
    models on train and test from one scoring pass."""
    li = li_frame(spark, sf_dir)
    feats = {f: F.col(f) for f in LI_FEATURES}
    g = G.gram(li.where(F.col("split") == "train"), feats, "y")[()]
    structs = []
    for m, names in MODELS.items():
        sub = _subset_gram(g, [LI_FEATURES.index(n) for n in names])
        b0, w = sub.ridge(0.0)
        pred = G.predict_expr(b0, w, {n: F.col(n) for n in names})
        structs.append(F.struct(F.lit(m).cast("bigint").alias("model"),
                                (F.col("y") - pred).alias("err")))
    e = li.select("split", F.explode(F.array(*structs)).alias("e")).select("split", "e.*")
    return e.groupBy("model", "split").agg(
        F.round(F.sum(F.col("err") * F.col("err")), 2).alias("rss"),
        F.round(F.sqrt(F.avg(F.col("err") * F.col("err"))), 6).alias("rmse"))


@query("regression_gradient", rows=("R7",), oracle=f"""
WITH {LI_SQL},
e AS (SELECT (1 + qty + disc + tax) - y AS err, qty, disc, tax FROM li)
SELECT 0::BIGINT AS index, 'constant' AS feature, round(2 * sum(err), 2) AS derivative FROM e
UNION ALL SELECT 1, 'qty', round(2 * sum(err * qty), 2) FROM e
UNION ALL SELECT 2, 'disc', round(2 * sum(err * disc), 2) FROM e
UNION ALL SELECT 3, 'tax', round(2 * sum(err * tax), 2) FROM e
""")
def regression_gradient(spark, sf_dir):
    """∂RSS/∂w_j = 2·Σ err·x_j for all features from the same errors, at w = (1, 1, 1, 1)."""
    li = li_frame(spark, sf_dir)
    err = (F.lit(1.0) + F.col("qty") + F.col("disc") + F.col("tax")) - F.col("y")
    cols = {"constant": F.lit(1.0), "qty": F.col("qty"), "disc": F.col("disc"), "tax": F.col("tax")}
    agg = li.agg(*[F.sum(err * c).alias(n) for n, c in cols.items()]).collect()[0]
    rows = [(i, n, round(2 * agg[n], 2)) for i, n in enumerate(cols)]
    return spark.createDataFrame(rows, "index bigint, feature string, derivative double")


GD_MAX_ITER = 100000


@query("linreg_gd", rows=("R8",), oracle=f"""
WITH RECURSIVE {LI_SQL},
g AS (SELECT count(*)::DOUBLE AS n, sum(qty / 50.0) AS sx, sum((qty / 50.0) * (qty / 50.0)) AS sxx,
             sum(y / 100.0) AS sy, sum((qty / 50.0) * (y / 100.0)) AS sxy FROM li),
it(k, w0, w1, done) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, false
  UNION ALL
  SELECT k + 1, CASE WHEN stop THEN w0 ELSE w0 - step * g0 END,
         CASE WHEN stop THEN w1 ELSE w1 - step * g1 END, stop
  FROM (SELECT k, w0, w1, 0.25 / g.n AS step, g0, g1, sqrt(g0 * g0 + g1 * g1) < 0.001 * g.n AS stop
        FROM (SELECT it.*, 2 * (g.n * w0 + g.sx * w1 - g.sy) AS g0,
                     2 * (g.sx * w0 + g.sxx * w1 - g.sxy) AS g1 FROM it, g WHERE NOT done
                     AND k < {GD_MAX_ITER}) s, g))
SELECT (k - 1)::BIGINT AS iterations, round(w0, 6) AS w0, round(w1, 6) AS w1 FROM it WHERE done
""")
def linreg_gd(spark, sf_dir):
    """Batch gradient descent on y/100 ~ 1 + qty/50; step 0.25/n, stop when ‖∇RSS‖ < 0.001·n.
    Every iteration runs on the 2×2 Gram (same iterates as the row-wise loop)."""
    li = li_frame(spark, sf_dir)
    g = G.gram(li, {"x": F.col("qty") / 50.0}, F.col("y") / 100.0)[()]
    Gm, b, _ = g.raw_system()
    w, it = G.gradient_descent(Gm, b, np.zeros(2), 0.25 / g.n, 0.001 * g.n, GD_MAX_ITER)
    return spark.createDataFrame([(it, round(float(w[0]), 6), round(float(w[1]), 6))],
                                 "iterations bigint, w0 double, w1 double")


# ------------------------------------------------------------------ polynomial and ridge

RIDGE_L2 = 10.0


@query("ridge_poly", rows=("R9",), oracle=f"""
WITH {PT_SQL},
src AS (SELECT x AS x1, x * x AS x2, y FROM pt WHERE split = 'train'),
{ols_ctes('src', ['x1', 'x2'], 'y', l2=str(RIDGE_L2))}
{_coef_sql(['power_1', 'power_2'])}
""")
def ridge_poly(spark, sf_dir):
    """Ridge (L2 = 10, intercept free) on the degree-2 polynomial of p_size/50, train split."""
    p = part_frame(spark, sf_dir).where(F.col("split") == "train")
    cols = poly_columns("x", 2)
    g = G.gram(p, {"power_1": cols[0], "power_2": cols[1]}, "y")[()]
    b0, w = g.ridge(RIDGE_L2)
    return _coef_df(spark, ["power_1", "power_2"], b0, w)


@query("poly_regression", rows=("R18",), oracle=f"""
WITH {PT_SQL},
src AS (SELECT x AS x1, x * x AS x2, x * x * x AS x3, y FROM pt WHERE split = 'train'),
{ols_ctes('src', ['x1', 'x2', 'x3'], 'y')}
{_coef_sql(['power_1', 'power_2', 'power_3'])}
""")
def poly_regression(spark, sf_dir):
    """Degree-3 polynomial regression of p_retailprice on p_size/50 (scaled to [0, 1])."""
    p = part_frame(spark, sf_dir).where(F.col("split") == "train")
    cols = poly_columns("x", 3)
    names = ["power_1", "power_2", "power_3"]
    g = G.gram(p, dict(zip(names, cols)), "y")[()]
    b0, w = g.ridge(0.0)
    return _coef_df(spark, names, b0, w)


@query("subset_models", rows=("R19",), oracle=f"""
WITH {PT_SQL},
src AS (SELECT 'set_' || ({sql_hash32('p_partkey', 9)} % 4 + 1)::VARCHAR AS subset, x AS x1,
               x * x AS x2, y FROM pt),
{ols_ctes('src', ['x1', 'x2'], 'y', group=['subset'])}
SELECT subset, round(b0, 6) AS b0, round(b1, 6) AS b1, round(b2, 6) AS b2 FROM ols
""")
def subset_models(spark, sf_dir):
    """The same degree-2 model fitted on four hash subsets from one grouped Gram scan."""
    p = part_frame(spark, sf_dir).withColumn(
        "subset", F.concat(F.lit("set_"), (bucket("p_partkey", 9, 4) + 1).cast("string")))
    cols = poly_columns("x", 2)
    grams = G.gram(p, {"x1": cols[0], "x2": cols[1]}, "y", by=["subset"])
    rows = []
    for (subset,), g in sorted(grams.items()):
        b0, w = g.ridge(0.0)
        rows.append((subset, round(float(b0), 6), round(float(w[0]), 6), round(float(w[1]), 6)))
    return spark.createDataFrame(rows, "subset string, b0 double, b1 double, b2 double")


RIDGE_GD_L2, RIDGE_GD_PASSES = 50.0, 100


@query("ridge_gd", rows=("R10", "R11"), oracle=f"""
WITH RECURSIVE {PT_SQL},
g AS (SELECT count(*)::DOUBLE AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y / 1000.0) AS sy,
             sum(x * (y / 1000.0)) AS sxy FROM pt),
it(k, w0, w1) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT k + 1, w0 - (0.25 / g.n) * (2 * (g.n * w0 + g.sx * w1 - g.sy)),
         w1 - (0.25 / g.n) * (2 * (g.sx * w0 + g.sxx * w1 - g.sxy) + 2 * {RIDGE_GD_L2} * w1)
  FROM it, g WHERE k < {RIDGE_GD_PASSES})
SELECT k::BIGINT AS passes, round(w0, 9) AS w0, round(w1, 9) AS w1 FROM it WHERE k = {RIDGE_GD_PASSES}
""")
def ridge_gd(spark, sf_dir):
    """Ridge gradient descent (constant not penalised), 100 full passes over the weights
    (we count passes, not per-weight steps), on p_retailprice/1000 ~ 1 + p_size/50."""
    p = part_frame(spark, sf_dir)
    g = G.gram(p, {"x": F.col("x")}, F.col("y") / 1000.0)[()]
    Gm, b, _ = g.raw_system()
    w = G.ridge_gradient_descent(Gm, b, np.zeros(2), 0.25 / g.n, RIDGE_GD_L2, RIDGE_GD_PASSES)
    return spark.createDataFrame([(RIDGE_GD_PASSES, round(float(w[0]), 9), round(float(w[1]), 9))],
                                 "passes bigint, w0 double, w1 double")


# ------------------------------------------------------------------ normalisation, lasso

@query("normalize_features", rows=("A14", "R13"), oracle="""
WITH nrm AS (SELECT sqrt(sum(p_size * p_size)) AS ns, sqrt(sum(p_retailprice * p_retailprice)) AS np
             FROM part)
SELECT p_partkey, round(p_size / ns, 9) AS size_n, round(p_retailprice / np, 9) AS price_n,
       round(ns, 6) AS size_norm, round(np, 6) AS price_norm FROM part, nrm
""")
def normalize_features(spark, sf_dir):
    """Column 2-norms in one pass, then every column divided by its norm."""
    p = Tables(spark, sf_dir).part
    r = p.agg(F.sqrt(F.sum(F.col("p_size") * F.col("p_size"))).alias("ns"),
              F.sqrt(F.sum(F.col("p_retailprice") * F.col("p_retailprice"))).alias("np")).collect()[0]
    return p.select("p_partkey", F.round(F.col("p_size") / F.lit(r["ns"]), 9).alias("size_n"),
                    F.round(F.col("p_retailprice") / F.lit(r["np"]), 9).alias("price_n"),
                    F.lit(round(r["ns"], 6)).alias("size_norm"),
                    F.lit(round(r["np"], 6)).alias("price_norm"))


def _normalised_system(g: G.Gram):
    Gm, b, yy = g.raw_system()
    norms = np.sqrt(np.diag(Gm))
    D = 1.0 / norms
    return Gm * np.outer(D, D), b * D, norms, yy


def _norm_sql(feats: list[str], src: str, name: str = "ns") -> str:
    """CTE with normalised Gram entries g{i}_{j}, b{i} and norms nrm{i} (i = 0 constant)."""
    cols = ["1.0"] + feats
    parts = []
    for i, a in enumerate(cols):
        parts.append(f"sqrt(sum(({a}) * ({a}))) AS nrm{i}")
        parts.append(f"sum(({a}) * y) AS sy{i}")
        for j, bcol in enumerate(cols):
            if j >= i:
                parts.append(f"sum(({a}) * ({bcol})) AS s{i}_{j}")
    raw = f"{name}_raw AS (SELECT {', '.join(parts)} FROM {src})"
    sel = []
    d = len(cols)
    for i in range(d):
        sel.append(f"sy{i} / nrm{i} AS b{i}")
        sel.append(f"nrm{i}")
        for j in range(d):
            a, c = min(i, j), max(i, j)
            sel.append(f"s{a}_{c} / (nrm{i} * nrm{j}) AS g{i}_{j}")
    return raw + f",\n{name} AS (SELECT {', '.join(sel)} FROM {name}_raw)"


LASSO_RHO_W = [1.0, 1.0, 1.0]


@query("lasso_rho", rows=("R14",), oracle=f"""
WITH {LI_SQL},
{_norm_sql(['qty', 'disc'], 'li')}
""" + "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS index, round(rho, 4) AS rho, round(2 * abs(rho), 4) AS l1_zero FROM "
    f"(SELECT b{i} - (" + " + ".join(f"g{i}_{j} * {LASSO_RHO_W[j]}" for j in range(3)) +
    f") + g{i}_{i} * {LASSO_RHO_W[i]} AS rho FROM ns)" for i in range(3)))
def lasso_rho(spark, sf_dir):
    """ρ_i on normalised features at w = (1, 1, 1), and the smallest L1 penalty that zeroes w_i."""
    li = li_frame(spark, sf_dir)
    g = G.gram(li, {"qty": F.col("qty"), "disc": F.col("disc")}, "y")[()]
    Gn, bn, _, _ = _normalised_system(g)
    rho = G.lasso_rho(Gn, bn, np.array(LASSO_RHO_W))
    rows = [(i, round(float(r), 4), round(float(2 * abs(r)), 4)) for i, r in enumerate(rho)]
    return spark.createDataFrame(rows, "index bigint, rho double, l1_zero double")


def _cd_sql(d: int, tol: float, max_cycles: int, lam_src: str, gram_cte: str) -> str:
    """Recursive CTE ``cd(k, l1, w0..w{d-1}, done)`` running cyclical coordinate descent
    for every penalty in ``lam_src`` (column l1) on normalised Gram ``gram_cte``."""
    ws = [f"w{i}" for i in range(d)]
    init = ", ".join(["0.0::DOUBLE"] * d)
    inner = f"SELECT cd.*, {gram_cte}.* FROM cd, {gram_cte} WHERE NOT done AND k < {max_cycles}"
    cur = {i: f"w{i}" for i in range(d)}
    for i in range(d):
        terms = " + ".join(f"g{i}_{j} * {cur[j]}" for j in range(d))
        rho = f"(b{i} - ({terms}) + g{i}_{i} * {cur[i]})"
        if i == 0:
            upd = rho
        else:
            upd = (f"CASE WHEN {rho} < -l1 / 2.0 THEN {rho} + l1 / 2.0 "
                   f"WHEN {rho} > l1 / 2.0 THEN {rho} - l1 / 2.0 ELSE 0.0 END")
        inner = f"SELECT *, {upd} AS n{i} FROM ({inner})"
        cur[i] = f"n{i}"
    change = " + ".join(f"abs(n{i} - w{i})" for i in range(d))
    step = (f"SELECT k + 1, l1, {', '.join(f'n{i}' for i in range(d))}, ({change}) < {tol} "
            f"FROM ({inner})")
    return (f"cd(k, l1, {', '.join(ws)}, done) AS (SELECT 0, l1, {init}, false FROM {lam_src}\n"
            f"UNION ALL\n{step})")


LASSO_L1, LASSO_TOL = 1.0e4, 1.0


def _lasso_weights(g: G.Gram, l1: float):
    Gn, bn, norms, _ = _normalised_system(g)
    w, cycles = G.lasso_coordinate_descent(Gn, bn, np.zeros(len(bn)), l1, LASSO_TOL)
    return w / norms, cycles


@query("lasso_cd", rows=("F15", "R15", "R16", "R17"), oracle=f"""
WITH RECURSIVE {LI_SQL},
{_norm_sql(LI_FEATURES, 'li')},
lam AS (SELECT {LASSO_L1}::DOUBLE AS l1),
{_cd_sql(4, LASSO_TOL, 100000, 'lam', 'ns')},
fin AS (SELECT * FROM cd WHERE done)
""" + "\nUNION ALL ".join(
    f"SELECT {i}::BIGINT AS index, round(w{i} / nrm{i}, 6) AS weight, k::BIGINT AS cycles FROM fin, ns"
    for i in range(4)))
def lasso_cd(spark, sf_dir):
    """Lasso by cyclical coordinate descent (covariance updates on the normalised Gram),
    weights rescaled to the raw features; L1 = 1e4, stop when Σ|Δw| over a cycle < 1."""
    li = li_frame(spark, sf_dir)
    g = G.gram(li, {f: F.col(f) for f in LI_FEATURES}, "y")[()]
    w, cycles = _lasso_weights(g, LASSO_L1)
    rows = [(i, round(float(v), 6), cycles) for i, v in enumerate(w)]
    return spark.createDataFrame(rows, "index bigint, weight double, cycles bigint")


LASSO_GRID = [1.0e2, 1.0e3, 1.0e4, 1.0e5, 1.0e6]


@query("lasso_path", rows=("A9", "R12", "R23"), oracle=f"""
WITH RECURSIVE {LI_SQL},
tr AS (SELECT * FROM li WHERE split = 'train'),
{_norm_sql(LI_FEATURES, 'tr')},
lam AS (SELECT unnest({LASSO_GRID}::DOUBLE[]) AS l1),
{_cd_sql(4, LASSO_TOL, 100000, 'lam', 'ns')},
fin AS (SELECT cd.l1, cd.k, w0 / nrm0 AS v0, w1 / nrm1 AS v1, w2 / nrm2 AS v2, w3 / nrm3 AS v3
        FROM cd, ns WHERE done),
ev AS (SELECT fin.l1, fin.k, sum((y - (v0 + v1 * qty + v2 * disc + v3 * tax)) ^ 2) AS rss,
              any_value((v1 <> 0)::INT + (v2 <> 0)::INT + (v3 <> 0)::INT) AS nnz
       FROM fin, li WHERE li.split = 'test' GROUP BY fin.l1, fin.k)
SELECT l1, k::BIGINT AS cycles, nnz::BIGINT AS nnz, round(rss, 2) AS val_rss,
       rss = min(rss) OVER () AS best FROM ev
""")
def lasso_path(spark, sf_dir):
    """L1 grid on train, validation RSS on the held-out split and nonzero count per penalty:
    one Gram scan for all fits, one scoring pass for all penalties."""
    li = li_frame(spark, sf_dir)
    feats = {f: F.col(f) for f in LI_FEATURES}
    g = G.gram(li.where(F.col("split") == "train"), feats, "y")[()]
    structs = []
    meta = []
    for l1 in LASSO_GRID:
        w, cycles = _lasso_weights(g, l1)
        nnz = int(sum(1 for v in w[1:] if v != 0))
        meta.append((l1, cycles, nnz))
        pred = G.predict_expr(w[0], w[1:], feats)
        structs.append(F.struct(F.lit(l1).alias("l1"), (F.col("y") - pred).alias("err")))
    e = (li.where(F.col("split") == "test").select(F.explode(F.array(*structs)).alias("e"))
         .select("e.*").groupBy("l1").agg(F.sum(F.col("err") * F.col("err")).alias("rss")))
    m = spark.createDataFrame(meta, "l1 double, cycles bigint, nnz bigint")
    from pyspark.sql import Window
    return (e.join(m, "l1").select("l1", "cycles", "nnz", F.round("rss", 2).alias("val_rss"),
                                   (F.col("rss") == F.min("rss").over(Window.partitionBy()))
                                   .alias("best")))


# ------------------------------------------------------------------ k-fold ridge

KFOLD_K = 10
KFOLD_GRID = [float(v) for v in np.logspace(1, 7, num=13)]


def _kfold_sql():
    grid = ", ".join(repr(v) for v in KFOLD_GRID)
    return f"""
WITH {PT_SQL},
tr AS (SELECT p_partkey, x AS x1, x * x AS x2, y FROM pt WHERE split = 'train'),
pos AS (SELECT *, row_number() OVER (ORDER BY {sql_hash32('p_partkey', 3)}, p_partkey) - 1 AS p FROM tr),
f AS (SELECT pos.*, (p * {KFOLD_K} + {KFOLD_K - 1}) // (SELECT count(*) FROM tr) AS fold FROM pos),
fs AS (SELECT fold, count(*)::DOUBLE AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy, sum(x1 * x1) AS s11,
              sum(x1 * x2) AS s12, sum(x2 * x2) AS s22, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y FROM f GROUP BY fold),
tot AS (SELECT sum(n) AS n, sum(s1) AS s1, sum(s2) AS s2, sum(sy) AS sy, sum(s11) AS s11, sum(s12) AS s12,
               sum(s22) AS s22, sum(s1y) AS s1y, sum(s2y) AS s2y FROM fs),
trn AS (SELECT fs.fold, tot.n - fs.n AS n, tot.s1 - fs.s1 AS s1, tot.s2 - fs.s2 AS s2, tot.sy - fs.sy AS sy,
               tot.s11 - fs.s11 AS s11, tot.s12 - fs.s12 AS s12, tot.s22 - fs.s22 AS s22,
               tot.s1y - fs.s1y AS s1y, tot.s2y - fs.s2y AS s2y FROM fs, tot),
lam AS (SELECT unnest([{grid}]::DOUBLE[]) AS l2),
cen AS (SELECT fold, l2, s1 / n AS m1, s2 / n AS m2, sy / n AS my,
               s11 - s1 * s1 / n + l2 AS a11, s12 - s1 * s2 / n AS a12, s22 - s2 * s2 / n + l2 AS a22,
               s1y - s1 * sy / n AS c1, s2y - s2 * sy / n AS c2 FROM trn, lam),
w AS (SELECT fold, l2, (c1 * a22 - a12 * c2) / (a11 * a22 - a12 * a12) AS w1,
             (a11 * c2 - a12 * c1) / (a11 * a22 - a12 * a12) AS w2, m1, m2, my FROM cen),
model AS (SELECT fold, l2, my - w1 * m1 - w2 * m2 AS w0, w1, w2 FROM w),
cv AS (SELECT model.l2, sum((f.y - (w0 + w1 * f.x1 + w2 * f.x2)) ^ 2) / {KFOLD_K} AS cv_error
       FROM f JOIN model ON f.fold = model.fold GROUP BY model.l2),
best AS (SELECT l2 FROM cv ORDER BY cv_error, l2 LIMIT 1),
{ols_ctes("(SELECT x1, x2, y FROM tr)", ['x1', 'x2'], 'y', l2='(SELECT l2 FROM best)', prefix='fin')},
test AS (SELECT sum((y - (fin.b0 + fin.b1 * x + fin.b2 * x * x)) ^ 2) AS rss FROM pt, fin WHERE split = 'test')
SELECT cv.l2, round(cv_error, 3) AS cv_error, cv.l2 = best.l2 AS best,
       CASE WHEN cv.l2 = best.l2 THEN round(test.rss, 3) END AS test_rss
FROM cv, best, test
"""


@query("ridge_kfold", rows=("W7", "R21", "R22"), oracle=_kfold_sql())
def ridge_kfold(spark, sf_dir):
    """10-fold CV error of 13 ridge penalties on the degree-2 model: fold Grams from one
    grouped scan, train Gram = total − fold, validation RSS from one scoring pass over all
    (fold, penalty) models; best penalty retrained on all training rows, test RSS."""
    p = part_frame(spark, sf_dir)
    tr = p.where(F.col("split") == "train")
    folds = kfold_assign(tr, "p_partkey", KFOLD_K, seed=3)
    cols = poly_columns("x", 2)
    feats = {"x1": cols[0], "x2": cols[1]}
    grams = G.gram(folds, feats, "y", by=["fold"])
    tot = G.total(grams)
    params = []
    for (fold,), gf in sorted(grams.items()):
        models = []
        for l2 in KFOLD_GRID:
            b0, w = (tot - gf).ridge(l2)
            models.append(F.struct(F.lit(l2).alias("l2"), F.lit(float(b0)).alias("b0"),
                                   F.lit(float(w[0])).alias("w1"), F.lit(float(w[1])).alias("w2")))
        params += [F.lit(fold), F.array(*models)]
    # each row meets only its own fold's models: (fold → models) is a literal map, 13 per row
    m = F.explode(F.element_at(F.create_map(*params), F.col("fold"))).alias("m")
    pred = F.col("m.b0") + F.col("m.w1") * cols[0] + F.col("m.w2") * cols[1]
    e = folds.select(m, "x", "y").select(F.col("m.l2").alias("l2"), (F.col("y") - pred).alias("err"))
    cv = e.groupBy("l2").agg((F.sum(F.col("err") * F.col("err")) / KFOLD_K).alias("cv"))
    cvs = {r["l2"]: r["cv"] for r in cv.collect()}
    best = min(cvs, key=lambda k: (cvs[k], k))
    b0, w = tot.ridge(best)
    err = F.col("y") - G.predict_expr(b0, w, feats)
    test_rss = p.where(F.col("split") == "test").agg(F.sum(err * err)).collect()[0][0]
    rows = [(l2, round(cvs[l2], 3), l2 == best, round(test_rss, 3) if l2 == best else None)
            for l2 in KFOLD_GRID]
    return spark.createDataFrame(rows, "l2 double, cv_error double, best boolean, test_rss double")


@query("covariance_matrix", rows=("A15",), oracle="""
WITH s AS (SELECT l_quantity / 50.0 AS a, l_discount * 10 AS b, l_tax * 10 AS c,
                  l_extendedprice / 100000.0 AS d FROM lineitem)
SELECT 'a' AS i, 'a' AS j, round(covar_samp(a, a), 8) AS cov FROM s UNION ALL
SELECT 'a', 'b', round(covar_samp(a, b), 8) FROM s UNION ALL
SELECT 'a', 'c', round(covar_samp(a, c), 8) FROM s UNION ALL
SELECT 'a', 'd', round(covar_samp(a, d), 8) FROM s UNION ALL
SELECT 'b', 'b', round(covar_samp(b, b), 8) FROM s UNION ALL
SELECT 'b', 'c', round(covar_samp(b, c), 8) FROM s UNION ALL
SELECT 'b', 'd', round(covar_samp(b, d), 8) FROM s UNION ALL
SELECT 'c', 'c', round(covar_samp(c, c), 8) FROM s UNION ALL
SELECT 'c', 'd', round(covar_samp(c, d), 8) FROM s UNION ALL
SELECT 'd', 'd', round(covar_samp(d, d), 8) FROM s
""")
def covariance_matrix(spark, sf_dir):
    """Sample covariance of all feature pairs in one aggregation (upper triangle, long form)."""
    li = Tables(spark, sf_dir).lineitem
    cols = {"a": F.col("l_quantity") / 50.0, "b": F.col("l_discount") * 10,
            "c": F.col("l_tax") * 10, "d": F.col("l_extendedprice") / 100000.0}
    s = li.select(*[v.alias(k) for k, v in cols.items()])
    names = list(cols)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    wide = s.agg(*[F.covar_samp(a, b).alias(f"{a}_{b}") for a, b in pairs])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"), F.round(F.col(f"{a}_{b}"), 8).alias("cov"))
        for a, b in pairs])).alias("s")).select("s.*")


# ------------------------------------------------------------------ degree selection (TSQR)

MAX_DEGREE = 15


@query("degree_selection", rows=("R18", "R20"))
def degree_selection(spark, sf_dir):
    """Polynomial degree 1..15 chosen by validation RSS. x = p_size/50 is scaled to [0, 1];
    the degree-15 powers are too ill-conditioned for the Gram, so one tall-skinny QR of
    [1, x, …, x¹⁵, y] over the training rows serves every degree (leading columns), and
    one scoring pass computes all fifteen validation RSS values."""
    from tessera.operators.qr import nested_least_squares, tsqr_r
    p = part_frame(spark, sf_dir)
    train = p.where(F.col("split") == "train")
    cols = [F.lit(1.0)] + poly_columns("x", MAX_DEGREE) + [F.col("y")]
    R = tsqr_r(train, cols)
    ws = {deg: nested_least_squares(R, deg + 1) for deg in range(1, MAX_DEGREE + 1)}
    aggs = []
    for deg, w in ws.items():
        pred = F.lit(float(w[-1]))
        for c in reversed(w[:-1]):               # Horner
            pred = pred * F.col("x") + F.lit(float(c))
        err = F.col("y") - pred
        aggs.append(F.sum(err * err).alias(f"d{deg}"))
    r = p.groupBy("split").agg(*aggs).collect()
    by = {row["split"]: row for row in r}
    best = min(ws, key=lambda d: (by["test"][f"d{d}"], d))
    rows = [(d, float(by["train"][f"d{d}"]), float(by["test"][f"d{d}"]), d == best) for d in ws]
    return spark.createDataFrame(rows, "degree bigint, train_rss double, validation_rss double, best boolean")
