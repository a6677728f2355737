"""Evaluation and logistic-regression queries.

Scored view (fixed values, see plans.fixtures): lineitem rows with a ±1 label and a
probability score from a fixed formula, so metrics need no fitted model.
Dense logistic features: 1, l_quantity/50 − 0.5, l_discount·10 − 0.5 with the same label.
Text model: documents ⋈ labels, label = 2·quality − 1, word weights = log-odds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, hash32, sql_hash32
from tessera.operators import evaluate as E
from tessera.operators import logistic as LG
from tessera.operators import minibatch as MB
from tessera.operators import text_features as TF
from tessera.operators.relational import with_row_index
from tessera.plans.fixtures import SCORED_LINEITEM_SQL, SELECTED_WORDS, scored_lineitem, \
    words_values_sql
from tessera.registry import query
from tessera.session import forget
from tessera.sources.tables import Tables

ROWKEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]
PR_THRESHOLDS = [0.5 + i / 198.0 for i in range(100)]
PR_TARGET = 0.9


def scored(spark, sf_dir):
    return scored_lineitem(Tables(spark, sf_dir).lineitem)


def rowkey(df):
    return F.concat_ws(":", *[F.col(c).cast("string") for c in ROWKEY_COLS],
                       F.col("l_quantity").cast("bigint").cast("string"))


S_SQL = f"s AS ({SCORED_LINEITEM_SQL})"
ROWKEY_SQL = ("concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, "
              "l_quantity::BIGINT)")


# ------------------------------------------------------------------ evaluation

@query("evaluate_binary", rows=("E1", "E3"), oracle=f"""
WITH {S_SQL},
p AS (SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE -1 END AS pred FROM s),
c AS (SELECT count_if(label = 1 AND pred = 1) AS tp, count_if(label = -1 AND pred = 1) AS fp,
             count_if(label = -1 AND pred = -1) AS tn, count_if(label = 1 AND pred = -1) AS fn FROM p)
SELECT (tp + fp + tn + fn)::BIGINT AS n, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
       round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn FROM c
""")
def evaluate_binary(spark, sf_dir):
    """Accuracy, precision, recall and the confusion counts at threshold 0.5, one aggregation."""
    s = scored(spark, sf_dir)
    pred = F.when(F.col("score") >= 0.5, 1).otherwise(-1)
    m = E.binary_metrics(s, "label", pred)
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")],
                    *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "tn", "fn")])


@query("confusion_matrix", rows=("E2", "E4"), oracle=f"""
WITH {S_SQL}
SELECT label, (CASE WHEN score >= 0.5 THEN 1 ELSE -1 END)::BIGINT AS pred, count(*)::BIGINT AS n
FROM s GROUP BY 1, 2
""")
def confusion_matrix(spark, sf_dir):
    s = scored(spark, sf_dir)
    return (s.select("label", F.when(F.col("score") >= 0.5, 1).otherwise(-1).cast("bigint")
                     .alias("pred"))
            .groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n")))


@query("mistake_cost", rows=("E5",), oracle=f"""
WITH {S_SQL},
c AS (SELECT count_if(label = -1 AND score >= 0.5) AS fp, count_if(label = 1 AND score < 0.5) AS fn FROM s)
SELECT fp::BIGINT AS fp, fn::BIGINT AS fn, (fn * 10000 + fp * 20000)::BIGINT AS cost FROM c
""")
def mistake_cost(spark, sf_dir):
    """Cost of mistakes: $10,000 per false negative, $20,000 per false positive."""
    s = scored(spark, sf_dir)
    c = s.agg(F.count_if((F.col("label") == -1) & (F.col("score") >= 0.5)).alias("fp"),
              F.count_if((F.col("label") == 1) & (F.col("score") < 0.5)).alias("fn"))
    return c.select(F.col("fp").cast("bigint"), F.col("fn").cast("bigint"),
                    (F.col("fn") * 10000 + F.col("fp") * 20000).cast("bigint").alias("cost"))


def _pr_sql(src: str) -> str:
    return f"""
t AS (SELECT 0.5 + i / 198.0 AS threshold FROM range(0, 100) r(i)),
c AS (SELECT threshold, count_if(score >= threshold AND label = 1) AS tp,
             count_if(score >= threshold AND label <> 1) AS fp FROM t, {src} GROUP BY threshold),
pr AS (SELECT threshold, tp / nullif(tp + fp, 0) AS precision,
              tp / (SELECT count_if(label = 1) FROM {src}) AS recall FROM c)
SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       threshold = (SELECT min(threshold) FROM pr WHERE precision >= {PR_TARGET}) AS first_at_target
FROM pr
"""


def _pr_frame(spark, df):
    pts = E.pr_curve(df, "score", "label", PR_THRESHOLDS)
    rows = [(t, tp / (tp + fp) if tp + fp else None, tp / npos if npos else None)
            for t, tp, fp, npos in pts]
    first = min((t for t, p, _ in rows if p is not None and p >= PR_TARGET), default=None)
    out = [(round(t, 6), None if p is None else round(p, 6), None if r is None else round(r, 6),
            t == first) for t, p, r in rows]
    return spark.createDataFrame(out, "threshold double, precision double, recall double, "
                                      "first_at_target boolean")


@query("pr_curve", rows=("E6", "E7"), oracle=f"WITH {S_SQL},{_pr_sql('s')}")
def pr_curve(spark, sf_dir):
    """Precision and recall at 100 thresholds in [0.5, 1] from one histogram pass; the smallest
    threshold reaching precision 0.9 is flagged."""
    return _pr_frame(spark, scored(spark, sf_dir))


@query("pr_curve_subset", rows=("E8",), oracle=f"""
WITH {S_SQL},
sub AS (SELECT s.* FROM s JOIN part ON s.l_partkey = part.p_partkey WHERE contains(lower(p_name), 'red')),
{_pr_sql('sub')}""")
def pr_curve_subset(spark, sf_dir):
    """The PR curve restricted to rows whose part name contains 'red' (case-insensitive)."""
    s = scored(spark, sf_dir)
    p = Tables(spark, sf_dir).part.where(F.lower("p_name").contains("red")).select("p_partkey")
    sub = s.join(p, s["l_partkey"] == p["p_partkey"], "left_semi")
    return _pr_frame(spark, sub)


@query("roc_curve", rows=("E9",), oracle=f"""
WITH {S_SQL},
g AS (SELECT score, count_if(label = 1) AS p, count_if(label <> 1) AS q FROM s GROUP BY score),
c AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS cp, sum(q) OVER (ORDER BY score DESC) AS cq,
             sum(p) OVER () AS tp, sum(q) OVER () AS tq FROM g),
l AS (SELECT *, coalesce(lag(cp) OVER (ORDER BY score DESC), 0) AS cp0,
             coalesce(lag(cq) OVER (ORDER BY score DESC), 0) AS cq0 FROM c)
SELECT round(score, 9) AS score, round(cp::DOUBLE / tp, 6) AS tpr, round(cq::DOUBLE / tq, 6) AS fpr,
       round(sum((cq - cq0) * (cp + cp0)) OVER ()::DOUBLE / (2.0 * tp * tq), 6) AS auc FROM l
""")
def roc_curve(spark, sf_dir):
    pts, auc = E.roc_points(scored(spark, sf_dir), "score", "label")
    return pts.select(F.round("score", 9).alias("score"), F.round("tpr", 6).alias("tpr"),
                      F.round("fpr", 6).alias("fpr"), F.lit(round(auc, 6)).alias("auc"))


@query("topk_scores", rows=("L4", "E10"), oracle=f"""
WITH {S_SQL}
(SELECT 'highest' AS kind, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, label,
        round(score, 9) AS score FROM s
 ORDER BY score DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents LIMIT 10)
UNION ALL
(SELECT 'lowest', l_orderkey, l_linenumber::BIGINT, l_partkey, label, round(score, 9) FROM s
 ORDER BY score ASC, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents LIMIT 10)
""")
def topk_scores(spark, sf_dir):
    """Ten highest and ten lowest scored rows (top-k, not a full sort)."""
    s = scored(spark, sf_dir)
    keys = [F.col(c) for c in ROWKEY_COLS]
    cols = [F.col("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
            "l_partkey", "label", F.round("score", 9).alias("score")]
    hi = s.orderBy(F.desc("score"), *keys).limit(10).select(F.lit("highest").alias("kind"), *cols)
    lo = s.orderBy(F.asc("score"), *keys).limit(10).select(F.lit("lowest").alias("kind"), *cols)
    return hi.unionByName(lo)


@query("accuracy", rows=("C12",), oracle=f"""
WITH {S_SQL}
SELECT CASE WHEN {sql_hash32(ROWKEY_SQL, 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split,
       round(avg(CASE WHEN (CASE WHEN score >= 0.5 THEN 1 ELSE -1 END) = label THEN 1.0 ELSE 0.0 END), 6)
         AS accuracy, count(*)::BIGINT AS n
FROM s GROUP BY 1
""")
def accuracy(spark, sf_dir):
    s = scored(spark, sf_dir)
    split = F.when(bucket(rowkey(s), 1) < 800, "train").otherwise("test")
    pred = F.when(F.col("score") >= 0.5, 1).otherwise(-1)
    return s.groupBy(split.alias("split")).agg(
        F.round(F.avg((pred == F.col("label")).cast("double")), 6).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


@query("majority_baseline", rows=("C13",), oracle=f"""
WITH l AS (SELECT doc_id, 2 * quality - 1 AS y,
                  CASE WHEN {sql_hash32('doc_id', 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split
           FROM labels),
m AS (SELECT CASE WHEN count_if(y = 1) >= count_if(y = -1) THEN 1 ELSE -1 END AS majority
      FROM l WHERE split = 'train')
SELECT majority::BIGINT AS majority, round(avg(CASE WHEN y = majority THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM l, m WHERE split = 'test' GROUP BY majority
""")
def majority_baseline(spark, sf_dir):
    """Accuracy on test of always predicting the training majority class."""
    lb = Tables(spark, sf_dir).labels.select(
        "doc_id", (2 * F.col("quality") - 1).alias("y"),
        F.when(bucket("doc_id", 1) < 800, "train").otherwise("test").alias("split"))
    c = lb.where(F.col("split") == "train").agg(F.count_if(F.col("y") == 1).alias("p"),
                                               F.count_if(F.col("y") == -1).alias("q")).collect()[0]
    maj = 1 if c["p"] >= c["q"] else -1
    return (lb.where(F.col("split") == "test")
            .agg(F.round(F.avg((F.col("y") == maj).cast("double")), 6).alias("accuracy"))
            .select(F.lit(maj).cast("bigint").alias("majority"), "accuracy"))


# ------------------------------------------------------------------ dense logistic

def dense_features():
    return [F.lit(1.0), F.col("l_quantity") / 50.0 - 0.5, F.col("l_discount") * 10 - 0.5]


DENSE_SQL = f"""{S_SQL},
d AS (SELECT CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END AS ind, 1.0 AS x0, l_quantity / 50.0 - 0.5 AS x1,
             l_discount * 10 - 0.5 AS x2 FROM s)"""
W_FIXED = [0.1, 0.2, -0.3]


@query("logistic_gradient", rows=("C6",), oracle=f"""
WITH {DENSE_SQL},
e AS (SELECT ind - 1 / (1 + exp(-({W_FIXED[0]} * x0 + {W_FIXED[1]} * x1 + {W_FIXED[2]} * x2))) AS err,
             x0, x1, x2 FROM d)
SELECT 0::BIGINT AS index, round(sum(err * x0), 4) AS derivative FROM e
UNION ALL SELECT 1, round(sum(err * x1), 4) FROM e
UNION ALL SELECT 2, round(sum(err * x2), 4) FROM e
""")
def logistic_gradient(spark, sf_dir):
    """∂ℓ/∂w_j = Σ (1[y=+1] − P(y=+1|x,w))·x_j for all j in one aggregation, w = (0.1, 0.2, −0.3)."""
    g, _ = LG.gradient_and_loglik(scored(spark, sf_dir), dense_features(), F.col("label"), W_FIXED)
    return spark.createDataFrame([(j, round(float(v), 4)) for j, v in enumerate(g)],
                                 "index bigint, derivative double")


@query("logistic_loglik", rows=("F13", "C7"), oracle=f"""
WITH {DENSE_SQL},
m AS (SELECT ind, {W_FIXED[0]} * x0 + {W_FIXED[1]} * x1 + {W_FIXED[2]} * x2 AS s FROM d)
SELECT round(sum((ind - 1) * s - CASE WHEN s < -30 THEN -s ELSE ln(1 + exp(-s)) END), 4) AS loglik,
       round(avg((ind - 1) * s - CASE WHEN s < -30 THEN -s ELSE ln(1 + exp(-s)) END), 9) AS avg_loglik
FROM m
""")
def logistic_loglik(spark, sf_dir):
    """Log likelihood with the overflow guard log(1+e^−s) ≈ −s for s < −30."""
    s_df = scored(spark, sf_dir)
    ind = F.when(F.col("label") == 1, 1.0).otherwise(0.0)
    s = LG.margin(W_FIXED, [f.cast("double") for f in dense_features()])
    ll = LG.loglik_expr(s, ind)
    return s_df.agg(F.round(F.sum(ll), 4).alias("loglik"), F.round(F.avg(ll), 9).alias("avg_loglik"))


GA_ITERS = 30


def _ga_sql(l2s: list[float], iters: int) -> str:
    lam = ", ".join(repr(float(v)) for v in l2s)
    return f"""
WITH RECURSIVE {DENSE_SQL},
n AS (SELECT count(*)::DOUBLE AS n FROM d),
it(k, l2, w0, w1, w2) AS (
  SELECT 0, l2, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM (SELECT unnest([{lam}]::DOUBLE[]) AS l2)
  UNION ALL
  SELECT k + 1, l2, w0 + (4.0 / n) * g0, w1 + (4.0 / n) * (g1 - 2 * l2 * w1),
         w2 + (4.0 / n) * (g2 - 2 * l2 * w2)
  FROM (SELECT k, l2, w0, w1, w2, sum(err * x0) AS g0, sum(err * x1) AS g1, sum(err * x2) AS g2
        FROM (SELECT it.*, d.x0, d.x1, d.x2,
                     d.ind - 1 / (1 + exp(-(w0 * d.x0 + w1 * d.x1 + w2 * d.x2))) AS err
              FROM it, d WHERE k < {iters})
        GROUP BY k, l2, w0, w1, w2), n)
SELECT l2, 0::BIGINT AS index, round(w0, 6) AS weight FROM it WHERE k = {iters}
UNION ALL SELECT l2, 1, round(w1, 6) FROM it WHERE k = {iters}
UNION ALL SELECT l2, 2, round(w2, 6) FROM it WHERE k = {iters}
"""


def _ga_frame(spark, sf_dir, l2s, iters):
    s_df = scored(spark, sf_dir)
    n = s_df.count()
    ws, _ = LG.gradient_ascent(s_df, dense_features(), F.col("label"), 4.0 / n, iters, l2s=l2s)
    rows = [(float(l2), j, round(float(v), 6)) for l2 in l2s for j, v in enumerate(ws[l2])]
    return spark.createDataFrame(rows, "l2 double, index bigint, weight double")


@query("logistic_ga", rows=("C8",), oracle=_ga_sql([0.0], GA_ITERS))
def logistic_ga(spark, sf_dir):
    """Batch gradient ascent, step 4/n, 30 iterations: one aggregation pass per iteration."""
    return _ga_frame(spark, sf_dir, [0.0], GA_ITERS)


@query("logistic_ga_l2", rows=("C9", "C10"), oracle=_ga_sql([1000.0], GA_ITERS))
def logistic_ga_l2(spark, sf_dir):
    """Gradient ascent with L2 penalty 1000 (derivative −2λw_j, intercept free)."""
    return _ga_frame(spark, sf_dir, [1000.0], GA_ITERS)


L2_PATH = [0.0, 4.0, 10.0, 1e2, 1e3, 1e5]


@query("l2_path", rows=("C11",), oracle=_ga_sql(L2_PATH, 20))
def l2_path(spark, sf_dir):
    """Coefficient path over six L2 penalties; all models advance in the same pass."""
    return _ga_frame(spark, sf_dir, L2_PATH, 20)


SGD_EPOCHS, SGD_BATCHES, SGD_STEP = 2, 10, 1.0


@query("sgd_epoch", rows=("C15", "C16"), oracle=f"""
WITH RECURSIVE {DENSE_SQL.replace('FROM s)', ', ' + ROWKEY_SQL + ' AS rk FROM s)')},
n AS (SELECT count(*) AS n FROM d),
pos AS (""" + "\nUNION ALL ".join(
    f"SELECT {e} AS epoch, d.*, row_number() OVER (ORDER BY {sql_hash32('rk', 5 + e)}, rk, x1, x2, ind) - 1 AS p FROM d"
    for e in range(SGD_EPOCHS)) + f"""),
b AS (SELECT pos.*, p // (n.n // {SGD_BATCHES}) AS batch FROM pos, n WHERE p < (n.n // {SGD_BATCHES}) * {SGD_BATCHES}),
it(k, w0, w1, w2, ll) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE
  UNION ALL
  SELECT k + 1, nw0, nw1, nw2,
         (SELECT avg((b2.ind - 1) * (nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2)
                     - CASE WHEN (nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2) < -30
                            THEN -(nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2)
                            ELSE ln(1 + exp(-(nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2))) END)
          FROM b b2 WHERE b2.epoch = k // {SGD_BATCHES} AND b2.batch = k % {SGD_BATCHES})
  FROM (SELECT k, w0 + {SGD_STEP} / cnt * g0 AS nw0, w1 + {SGD_STEP} / cnt * g1 AS nw1,
               w2 + {SGD_STEP} / cnt * g2 AS nw2
        FROM (SELECT k, w0, w1, w2, count(*) AS cnt, sum(err * x0) AS g0, sum(err * x1) AS g1,
                     sum(err * x2) AS g2
              FROM (SELECT it.k, it.w0, it.w1, it.w2, b.x0, b.x1, b.x2,
                           b.ind - 1 / (1 + exp(-(it.w0 * b.x0 + it.w1 * b.x1 + it.w2 * b.x2))) AS err
                    FROM it JOIN b ON b.epoch = it.k // {SGD_BATCHES} AND b.batch = it.k % {SGD_BATCHES}
                    WHERE it.k < {SGD_EPOCHS * SGD_BATCHES})
              GROUP BY k, w0, w1, w2)))
SELECT k::BIGINT AS step, round(ll, 6) AS batch_avg_loglik, round(w0, 6) AS w0, round(w1, 6) AS w1,
       round(w2, 6) AS w2 FROM it WHERE k > 0
""")
def sgd_epoch(spark, sf_dir):
    """Mini-batch stochastic gradient ascent: each epoch a new seeded shuffle (positions from a
    distributed row index), 10 contiguous batches (remainder dropped), step/B per batch; the
    average log likelihood of each batch after its update."""
    s_df = scored(spark, sf_dir)
    rk = rowkey(s_df)
    feats = dense_features()
    base = s_df.select(rk.alias("rk"), *[f.cast("double").alias(f"x{i}") for i, f in enumerate(feats)],
                       F.when(F.col("label") == 1, 1.0).otherwise(0.0).alias("ind"))
    n = base.count()
    bsize = n // SGD_BATCHES
    epochs = []
    for e in range(SGD_EPOCHS):
        h = base.withColumn("_h", hash32("rk", 5 + e))
        pos = with_row_index(h, [F.col("_h"), F.col("rk"), F.col("x1"), F.col("x2"), F.col("ind")], "p")
        epochs.append(pos.where(F.col("p") < bsize * SGD_BATCHES)
                      .select(F.lit(e).alias("epoch"), (F.col("p") / bsize).cast("bigint").alias("batch"),
                              "x0", "x1", "x2", "ind"))
    allb = epochs[0]
    for e in epochs[1:]:
        allb = allb.unionByName(e)
    allb = allb.withColumn("step", F.col("epoch") * SGD_BATCHES + F.col("batch")).persist()
    xs = [F.col("x0"), F.col("x1"), F.col("x2")]
    w = np.zeros(3)
    rows = []
    n_steps = SGD_EPOCHS * SGD_BATCHES
    try:
        # one pass per step: the gradient of batch k and the log likelihood of batch k-1 both
        # use the same weights (those after step k-1), so they share a scan
        for k in range(n_steps + 1):
            cur, prev = F.col("step") == k, F.col("step") == k - 1
            err = F.col("ind") - LG.sigmoid(LG.margin(w, xs))
            ll = LG.loglik_expr(LG.margin(w, xs), F.col("ind"))
            r = (allb.where(F.col("step").isin(k - 1, k))
                 .agg(F.count_if(cur).alias("c"), F.count_if(prev).alias("pc"),
                      F.sum(F.when(prev, ll)).alias("ll"),
                      *[F.sum(F.when(cur, err * x)).alias(f"g{j}") for j, x in enumerate(xs)])
                 .collect()[0])
            if k > 0:
                rows.append((k, round(r["ll"] / r["pc"], 6), *[round(float(v), 6) for v in w]))
            if k < n_steps:
                w = w + SGD_STEP / r["c"] * np.array([r["g0"], r["g1"], r["g2"]])
    finally:
        allb.unpersist()
    return spark.createDataFrame(rows, "step bigint, batch_avg_loglik double, w0 double, w1 double, "
                                       "w2 double")


MINI_EPOCHS, MINI_BATCHES, MINI_STEPS = 3, 100, [10.0 ** e for e in range(-4, 3)]

_MINI_LL = ("(b2.ind - 1) * (nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2) - CASE WHEN (nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2) < -30 "
            "THEN -(nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2) ELSE ln(1 + exp(-(nw0 * b2.x0 + nw1 * b2.x1 + nw2 * b2.x2))) END")


def minibatch_sql(epochs: int, batches: int, salt: int, steps: list[float], columns: str) -> str:
    """Oracle of mini-batch ascent: one recursion over the steps of all epochs, for all step sizes."""
    return f"""
WITH RECURSIVE {DENSE_SQL.replace('FROM s)', ', ' + ROWKEY_SQL + ' AS rk FROM s)')},
n AS (SELECT count(*) AS n FROM d),
pos AS (""" + "\nUNION ALL ".join(
        f"SELECT {e} AS epoch, d.*, row_number() OVER (ORDER BY {sql_hash32('rk', salt + e)}, rk, x1, x2, ind) - 1 AS p FROM d"
        for e in range(epochs)) + f"""),
b AS MATERIALIZED (SELECT epoch * {batches} + p // (n.n // {batches}) AS step, x0, x1, x2, ind FROM pos, n WHERE p < (n.n // {batches}) * {batches}),
it(k, size, w0, w1, w2, ll) AS (
  SELECT 0, size, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE FROM (SELECT unnest({steps}::DOUBLE[]) AS size)
  UNION ALL
  SELECT k + 1, size, nw0, nw1, nw2, avg({_MINI_LL})
  FROM (SELECT k, size, w0 + size / cnt * g0 AS nw0, w1 + size / cnt * g1 AS nw1, w2 + size / cnt * g2 AS nw2
        FROM (SELECT k, size, w0, w1, w2, count(*) AS cnt, sum(err * x0) AS g0, sum(err * x1) AS g1, sum(err * x2) AS g2
              FROM (SELECT it.*, b.x0, b.x1, b.x2, b.ind - 1 / (1 + exp(-greatest(it.w0 * b.x0 + it.w1 * b.x1 + it.w2 * b.x2, -700))) AS err
                    FROM it JOIN b ON b.step = it.k WHERE it.k < {epochs * batches})
              GROUP BY k, size, w0, w1, w2)) u JOIN b b2 ON b2.step = u.k
  GROUP BY k, size, nw0, nw1, nw2)
SELECT {columns} FROM it WHERE k > 0
"""


@query("sgd_minibatch", rows=("C15", "C16", "C17"), oracle=minibatch_sql(
    MINI_EPOCHS, MINI_BATCHES, 15, MINI_STEPS, "size AS step_size, k::BIGINT AS step, round(ll, 5) AS batch_avg_loglik"))
def sgd_minibatch(spark, sf_dir):
    """Mini-batch ascent in batches of 1 % of the rows, three epochs with a new shuffle each, for
    seven step sizes from 1e-4 to 1e2 at once: average log likelihood of every batch after its
    update. Batches are partitions of a table; a step's scan has a partition filter."""
    s_df = scored(spark, sf_dir)
    x = F.array(*[f.cast("double") for f in dense_features()])
    rows = s_df.select(rowkey(s_df).alias("rk"), x.alias("x"), F.when(F.col("label") == 1, 1.0).otherwise(0.0).alias("ind"))
    order = [F.col("rk"), F.col("x")[1], F.col("x")[2], F.col("ind")]
    table = MB.batch_table(rows, order, list(range(15, 15 + MINI_EPOCHS)), lambda salt: hash32("rk", salt), MINI_BATCHES)
    out = MB.ascend(table, 3, MINI_EPOCHS * MINI_BATCHES, MINI_STEPS)
    forget(table)
    return spark.createDataFrame([(size, k, round(float(v), 5)) for k, ll, _ in out for size, v in zip(MINI_STEPS, ll)],
                                 "step_size double, step bigint, batch_avg_loglik double")


# ------------------------------------------------------------------ text model (log-odds weights)

def labelled_word_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lb = t.labels.select("doc_id", (2 * F.col("quality") - 1).alias("y"))
    wc = TF.word_counts(t.documents.join(lb, "doc_id", "left_semi"), "doc_id")
    return wc.join(lb, "doc_id"), lb


def word_log_odds(wc_lab):
    """weight(word) = ln((count in positive docs + 1) / (count in negative docs + 1))."""
    return wc_lab.groupBy("word").agg(
        F.log((F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("count"))), F.lit(0)) + 1).cast("double")
              / (F.coalesce(F.sum(F.when(F.col("y") == -1, F.col("count"))), F.lit(0)) + 1))
        .alias("weight"))


_LOGODDS_SQL = f"""
lb AS (SELECT doc_id, 2 * quality - 1 AS y FROM labels),
wc AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
        (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents
         WHERE doc_id IN (SELECT doc_id FROM lb)) WHERE w <> '' GROUP BY 1, 2),
lo AS (SELECT word, ln((coalesce(sum(cnt) FILTER (WHERE y = 1), 0) + 1)::DOUBLE
                       / (coalesce(sum(cnt) FILTER (WHERE y = -1), 0) + 1)) AS weight
       FROM wc JOIN lb USING (doc_id) GROUP BY word)"""


@query("coefficient_signs", rows=("C4", "C14"), oracle=f"""
WITH {_LOGODDS_SQL},
cnt AS (SELECT count_if(weight > 0)::BIGINT AS n_positive, count_if(weight < 0)::BIGINT AS n_negative FROM lo),
tp AS (SELECT 'positive' AS kind, word, weight, row_number() OVER (ORDER BY round(weight, 9) DESC, word) AS rk FROM lo),
tn AS (SELECT 'negative' AS kind, word, weight, row_number() OVER (ORDER BY round(weight, 9) ASC, word) AS rk FROM lo)
SELECT kind, rk::BIGINT AS rank, word, round(weight, 6) AS weight, n_positive, n_negative
FROM (SELECT * FROM tp WHERE rk <= 10 UNION ALL SELECT * FROM tn WHERE rk <= 10), cnt
""")
def coefficient_signs(spark, sf_dir):
    """Word weights of the log-odds text model: counts of positive and negative weights and the
    ten most positive and most negative words."""
    wc, _ = labelled_word_counts(spark, sf_dir)
    lo = word_log_odds(wc).persist()
    c = lo.agg(F.count_if(F.col("weight") > 0).alias("n_positive"),
               F.count_if(F.col("weight") < 0).alias("n_negative")).collect()[0]
    top = []
    for kind, order in (("positive", F.desc(F.round("weight", 9))),
                        ("negative", F.asc(F.round("weight", 9)))):
        t = lo.orderBy(order, "word").limit(10).collect()
        top += [(kind, i + 1, r["word"], round(r["weight"], 6)) for i, r in enumerate(t)]
    lo.unpersist()
    df = spark.createDataFrame(top, "kind string, rank bigint, word string, weight double")
    return df.select("*", F.lit(c["n_positive"]).cast("bigint").alias("n_positive"),
                     F.lit(c["n_negative"]).cast("bigint").alias("n_negative"))


@query("score_logistic", rows=("F11", "F22", "C3", "C5"), oracle=f"""
WITH {_LOGODDS_SQL},
sel AS (SELECT lo.* FROM lo JOIN {words_values_sql()} USING (word)),
b AS (SELECT ln(count_if(y = 1)::DOUBLE / count_if(y = -1)) AS b0 FROM lb),
dw AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
        (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents)
       WHERE w <> '' GROUP BY 1, 2),
m AS (SELECT d.doc_id, b.b0 + coalesce(sum(dw.cnt * sel.weight), 0) AS margin
      FROM documents d CROSS JOIN b LEFT JOIN dw ON dw.doc_id = d.doc_id
           LEFT JOIN sel ON sel.word = dw.word
      GROUP BY d.doc_id, b.b0)
SELECT doc_id, round(margin, 6) AS margin, round(1 / (1 + exp(-margin)), 6) AS probability,
       (CASE WHEN margin > 0 THEN 1 ELSE -1 END)::BIGINT AS class FROM m
""")
def score_logistic(spark, sf_dir):
    """Score every document with the log-odds model restricted to the 20 listed words:
    margin = b0 + Σ weight·count (sparse: word join against the broadcast weights),
    probability = sigmoid(margin), class = +1 when margin > 0."""
    wc, lb = labelled_word_counts(spark, sf_dir)
    sel = spark.createDataFrame([(w,) for w in SELECTED_WORDS], "word string")
    weights = word_log_odds(wc.join(F.broadcast(sel), "word"))          # ≤ 20 rows
    c = lb.agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == -1).alias("q")) \
        .collect()[0]
    b0 = float(np.log(c["p"] / c["q"]))
    docs = Tables(spark, sf_dir).documents
    dw = TF.word_counts(docs, "doc_id")
    part = (dw.join(F.broadcast(weights), "word")
            .groupBy("doc_id").agg(F.sum(F.col("count") * F.col("weight")).alias("s")))
    m = docs.select("doc_id").join(part, "doc_id", "left") \
        .select("doc_id", (F.lit(b0) + F.coalesce("s", F.lit(0.0))).alias("margin"))
    return m.select("doc_id", F.round("margin", 6).alias("margin"),
                    F.round(LG.sigmoid(F.col("margin")), 6).alias("probability"),
                    F.when(F.col("margin") > 0, 1).otherwise(-1).cast("bigint").alias("class"))
