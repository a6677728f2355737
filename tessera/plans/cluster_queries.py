"""k-means, k-means++, Gaussian mixture and cluster-profile queries.

Fixtures (fixed values):
  vectors: embeddings (as double); initial centroids: the 5 rows with the smallest
           md5(vec_id:21); k-means++ seed 23.
  colours: (l_quantity/50, l_discount·10, l_tax·10) per lineitem row; GMM start: the 3 rows
           with the smallest md5(rowkey:31) as means, weights 1/3, the sample covariance of
           all rows for every component.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.functions.hashing import hash32, sql_hash32, sql_uniform
from tessera.operators import gmm as GM
from tessera.operators import kmeans as KM
from tessera.operators import neighbors as NB
from tessera.operators import text_features as TF
from tessera.registry import query
from tessera.session import written
from tessera.sources.tables import Tables, spread

K, INIT_SEED, PP_SEED, LLOYD_ITERS = 5, 21, 23, 3


def vectors(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    return spread(e.select("vec_id", V.to_double("embedding").alias("v")))


def init_centroids(ev, k=K, seed=INIT_SEED) -> np.ndarray:
    rows = ev.orderBy(hash32("vec_id", seed), "vec_id").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=float)


_EV = "ev AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_C0 = (f"c0 AS (SELECT (row_number() OVER (ORDER BY {sql_hash32('vec_id', INIT_SEED)}, vec_id) - 1)::BIGINT "
       f"AS k, v AS c FROM ev QUALIFY row_number() OVER (ORDER BY {sql_hash32('vec_id', INIT_SEED)}, vec_id) <= {K})")
_D2 = "list_sum(list_transform(range(1, len(c.c) + 1), lambda i: (e.v[i] - c.c[i]) ^ 2))"


def _assign_sql(t: int) -> str:
    return (f"a{t} AS (SELECT vec_id, v, k, d FROM (SELECT e.vec_id, e.v, c.k, {_D2} AS d, "
            f"row_number() OVER (PARTITION BY e.vec_id ORDER BY {_D2}, c.k) AS rn FROM ev e, c{t} c) "
            f"WHERE rn = 1)")


def _revise_sql(t: int) -> str:
    return (f"m{t + 1} AS (SELECT k, list(a ORDER BY i) AS c, any_value(n) AS n FROM ("
            f"SELECT k, i, avg(x) AS a, count(*) AS n FROM (SELECT k, unnest(v) AS x, "
            f"generate_subscripts(v, 1) AS i FROM a{t}) GROUP BY k, i) GROUP BY k),\n"
            f"c{t + 1} AS (SELECT c{t}.k, coalesce(m{t + 1}.c, c{t}.c) AS c FROM c{t} "
            f"LEFT JOIN m{t + 1} USING (k))")


def _lloyd_sql(T: int) -> str:
    parts = [_EV, _C0]
    for t in range(T):
        parts.append(_assign_sql(t))
        parts.append(_revise_sql(t))
        parts.append(f"h{t} AS (SELECT sum(list_sum(list_transform(range(1, len(c.c) + 1), "
                     f"lambda i: (a.v[i] - c.c[i]) ^ 2))) AS het FROM a{t} a JOIN c{t + 1} c ON a.k = c.k)")
        if t:
            parts.append(f"ch{t} AS (SELECT count_if(a.k <> p.k) AS changed FROM a{t} a JOIN a{t - 1} p "
                         f"USING (vec_id))")
    parts.append("tr AS (" + " UNION ALL ".join(
        f"SELECT {t} AS iteration, (SELECT het FROM h{t}) AS het, "
        + ("NULL::BIGINT" if t == 0 else f"(SELECT changed FROM ch{t})") + " AS changed"
        for t in range(T)) + ")")
    return ",\n".join(parts)


@query("assign_clusters", rows=("A12", "K2"), oracle=f"""
WITH {_EV}, {_C0}, {_assign_sql(0)}
SELECT vec_id, k AS cluster, round(d, 6) AS sq_dist FROM a0
""")
def assign_clusters(spark, sf_dir):
    """Nearest of the initial centroids for every vector (argmin; lowest index wins ties)."""
    ev = vectors(spark, sf_dir)
    a = KM.assign(ev, "v", init_centroids(ev))
    return a.select("vec_id", "cluster", F.round("sq_dist", 6).alias("sq_dist"))


@query("revise_centroids", rows=("A16", "K3"), oracle=f"""
WITH {_EV}, {_C0}, {_assign_sql(0)}, {_revise_sql(0)}
SELECT k AS cluster, list_transform(c, lambda x: round(x, 6)) AS centroid, n::BIGINT AS n FROM m1
""")
def revise_centroids(spark, sf_dir):
    """Mean vector of each cluster's members (one grouped vector sum)."""
    ev = vectors(spark, sf_dir)
    a = KM.assign(ev, "v", init_centroids(ev))
    sums = KM.cluster_sums(a, "v", F.col("cluster"))
    rows = [(int(k), [round(float(x), 6) for x in s / n], int(n)) for k, (n, s) in sorted(sums.items())]
    return spark.createDataFrame(rows, "cluster bigint, centroid array<double>, n bigint")


@query("heterogeneity", rows=("K4",), oracle=f"""
WITH {_EV}, {_C0}, {_assign_sql(0)}
SELECT round(sum(d), 6) AS heterogeneity FROM a0
""")
def heterogeneity(spark, sf_dir):
    ev = vectors(spark, sf_dir)
    h = KM.heterogeneity(ev, "v", init_centroids(ev))
    return spark.createDataFrame([(round(h, 6),)], "heterogeneity double")


def _lloyd(spark, sf_dir, iters=LLOYD_ITERS):
    ev = vectors(spark, sf_dir).persist()
    cents, trace = KM.lloyd(ev, "v", init_centroids(ev), iters)
    return ev, cents, trace


@query("kmeans_lloyd", rows=("K1", "K5"), oracle=f"""
WITH {_lloyd_sql(LLOYD_ITERS)}
SELECT iteration::BIGINT AS iteration, round(het, 6) AS heterogeneity, changed::BIGINT AS changed FROM tr t
WHERE NOT EXISTS (SELECT 1 FROM tr u WHERE u.iteration <= t.iteration AND u.changed = 0)
""")
def kmeans_lloyd(spark, sf_dir):
    """Three Lloyd iterations from the hash-chosen start: heterogeneity and changed assignments."""
    ev, _, trace = _lloyd(spark, sf_dir)
    ev.unpersist()
    rows = [(it, round(h, 6), ch) for it, h, ch in trace]
    return spark.createDataFrame(rows, "iteration bigint, heterogeneity double, changed bigint")


@query("cluster_sizes", rows=("A8",), oracle=f"""
WITH {_lloyd_sql(LLOYD_ITERS)}, {_assign_sql(LLOYD_ITERS)}
SELECT k AS cluster, count(*)::BIGINT AS n, count(*) < (SELECT count(*) FROM ev) / 10.0 AS small
FROM a{LLOYD_ITERS} GROUP BY k
""")
def cluster_sizes(spark, sf_dir):
    """Cluster sizes after k-means and the clusters below a tenth of the data."""
    ev, cents, _ = _lloyd(spark, sf_dir)
    total = ev.count()
    sizes = (KM.assign(ev, "v", cents).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
             .select("cluster", "n", (F.col("n") < total / 10.0).alias("small")))
    out = spark.createDataFrame(sizes.collect(), sizes.schema)
    ev.unpersist()
    return out


@query("top_per_cluster", rows=("A13", "K10"), oracle=f"""
WITH {_lloyd_sql(LLOYD_ITERS)}, {_assign_sql(LLOYD_ITERS)}
SELECT k AS cluster, vec_id, rk::BIGINT AS rank, round(d, 6) AS sq_dist FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(d, 9), vec_id) AS rk FROM a{LLOYD_ITERS})
WHERE rk <= 3
""")
def top_per_cluster(spark, sf_dir):
    """The three members nearest to each final centroid (top-k per group)."""
    ev, cents, _ = _lloyd(spark, sf_dir)
    a = KM.assign(ev, "v", cents)
    top = NB.topk_per_group(a, "cluster", [F.round("sq_dist", 9), F.col("vec_id")], 3)
    res = top.select("cluster", "vec_id", "rank", F.round("sq_dist", 6).alias("sq_dist"))
    out = spark.createDataFrame(res.collect(), res.schema)
    ev.unpersist()
    return out


_PP_PARTS = [_EV, f"p0 AS (SELECT 0 AS r, vec_id, v FROM ev ORDER BY {sql_hash32('vec_id', PP_SEED)}, vec_id LIMIT 1)"]
for _r in range(1, K):
    _prev = " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(_r))
    _PP_PARTS.append(
        f"p{_r} AS (SELECT {_r} AS r, vec_id, v FROM (SELECT e.vec_id, e.v, "
        f"ln({sql_uniform('e.vec_id', PP_SEED + _r)}) / min(list_sum(list_transform(range(1, len(c.v) + 1), "
        f"lambda i: (e.v[i] - c.v[i]) ^ 2))) AS s FROM ev e, ({_prev}) c GROUP BY e.vec_id, e.v "
        f"HAVING min(list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (e.v[i] - c.v[i]) ^ 2))) > 0) "
        f"ORDER BY s DESC, vec_id LIMIT 1)")


@query("kmeans_pp", rows=("X7", "K7"), oracle=f"""
WITH {', '.join(_PP_PARTS)}
SELECT r::BIGINT AS round, vec_id FROM (""" + " UNION ALL ".join(f"SELECT r, vec_id FROM p{j}" for j in range(K)) + ")")
def kmeans_pp(spark, sf_dir):
    """k-means++ centres: each draw ∝ D² by the one-pass key log(u)/D² (no cumulative array)."""
    ev = vectors(spark, sf_dir).persist()
    chosen = KM.kmeans_pp(ev, "vec_id", "v", K, PP_SEED)
    ev.unpersist()
    return spark.createDataFrame([(r, int(vid)) for r, (vid, _) in enumerate(chosen)],
                                 "round bigint, vec_id bigint")


@query("cluster_top_words", rows=("L5", "K10", "K21"), oracle=f"""
WITH dw AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
        (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents)
        WHERE w <> '' GROUP BY 1, 2),
idf AS (SELECT word, ln((SELECT count(*) FROM documents)::DOUBLE / count(*)) AS idf FROM dw GROUP BY word
        HAVING count(*) < (SELECT count(*) FROM documents)),
dt AS (SELECT doc_id, word, cnt * idf AS tfidf FROM dw JOIN idf USING (word)),
sz AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
m AS (SELECT d.source, dt.word, sum(dt.tfidf) / any_value(sz.n) AS mean_tfidf
      FROM dt JOIN documents d USING (doc_id) JOIN sz ON sz.source = d.source GROUP BY d.source, dt.word)
SELECT source, word, rk::BIGINT AS rank, round(mean_tfidf, 6) AS mean_tfidf FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(mean_tfidf, 9) DESC, word) AS rk FROM m)
WHERE rk <= 5
""")
def cluster_top_words(spark, sf_dir):
    """Top 5 words of each document group's mean TF-IDF vector (groups = source)."""
    docs = Tables(spark, sf_dir).documents
    src = docs.select("doc_id", "source")
    sz = src.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # a group's sum of count · idf is its count times idf, so entries are added up where they are counted
    g = written(TF.word_counts_by(docs, "doc_id", "source").groupBy("source", "word")
                .agg(F.count(F.lit(1)).alias("docs"), F.sum("count").alias("count")), "group-counts")
    idf = TF.idf_table(g, docs.count(), F.sum("docs"))
    # dealt by word once, for the sums and the join
    m = (g.select(F.explode("source").alias("source"), "word", "count").repartition("word").groupBy("source", "word").agg(F.sum("count").alias("c"))
         .join(idf, "word").join(F.broadcast(sz), "source")   # one row per source group
         .select("source", "word", (F.col("c") * F.col("idf") / F.col("n")).alias("mean_tfidf")))
    top = NB.topk_per_group(m, "source", [F.desc(F.round("mean_tfidf", 9)), F.col("word")], 5)
    return top.select("source", "word", "rank", F.round("mean_tfidf", 6).alias("mean_tfidf"))


# ------------------------------------------------------------------ Gaussian mixtures (3-d colours)

GMM_K, GMM_SEED = 3, 31


def colours(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    rowkey = F.concat_ws(":", *[F.col(c).cast("string") for c in
                                ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                         cents.cast("string"), F.col("l_quantity").cast("bigint").cast("string"))
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     rowkey.alias("rowkey"), (F.col("l_quantity") / 50.0).alias("r"),
                     (F.col("l_discount") * 10 + 0.0).alias("g"), (F.col("l_tax") * 10 + 0.0).alias("b"))


def xs():
    return [F.col("r"), F.col("g"), F.col("b")]


def gmm_start(col_df):
    rows = col_df.orderBy(hash32("rowkey", GMM_SEED), "rowkey").limit(GMM_K).collect()
    means = [np.array([r["r"], r["g"], r["b"]]) for r in rows]
    names = ["r", "g", "b"]
    cov_row = col_df.agg(*[F.covar_samp(a, b).alias(f"{a}{b}") for a in names for b in names]).collect()[0]
    cov = np.array([[cov_row[f"{a}{b}"] for b in names] for a in names])
    return [1.0 / GMM_K] * GMM_K, means, [cov.copy() for _ in range(GMM_K)]


_COL_SQL = """col AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity / 50.0 AS r,
       l_discount * 10 + 0.0 AS g, l_tax * 10 + 0.0 AS b,
       concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT,
                 l_quantity::BIGINT) AS rowkey, row_number() OVER () AS rid FROM lineitem)"""
_AX = ["r", "g", "b"]


def _gmm_params0_sql() -> str:
    mean_rows = (f"mr AS (SELECT (row_number() OVER (ORDER BY {sql_hash32('rowkey', GMM_SEED)}, rowkey) - 1) AS k, "
                 f"r, g, b FROM col QUALIFY row_number() OVER (ORDER BY {sql_hash32('rowkey', GMM_SEED)}, rowkey) <= {GMM_K})")
    cov = ", ".join(f"covar_samp({a}, {b}) AS c{i}{j}" for i, a in enumerate(_AX) for j, b in
                    enumerate(_AX) if j >= i)
    return (mean_rows + f",\ngc AS (SELECT {cov} FROM col),\n"
            f"par0 AS (SELECT mr.k, 1.0 / {GMM_K} AS w, mr.r AS m0, mr.g AS m1, mr.b AS m2, gc.* FROM mr, gc)")


def _inv_sql(par: str, out: str) -> str:
    """Inverse and log-determinant of each component's symmetric 3×3 covariance."""
    a, b, c, d, e, f = "c00", "c01", "c02", "c11", "c12", "c22"
    det = f"({a} * ({d} * {f} - {e} * {e}) - {b} * ({b} * {f} - {c} * {e}) + {c} * ({b} * {e} - {c} * {d}))"
    return (f"{out} AS (SELECT k, w, m0, m1, m2, ln({det}) AS ld, "
            f"({d} * {f} - {e} * {e}) / {det} AS i00, ({c} * {e} - {b} * {f}) / {det} AS i01, "
            f"({b} * {e} - {c} * {d}) / {det} AS i02, ({a} * {f} - {c} * {c}) / {det} AS i11, "
            f"({b} * {c} - {a} * {e}) / {det} AS i12, ({a} * {d} - {b} * {b}) / {det} AS i22 FROM {par})")


def _lj_sql(inv: str, out: str) -> str:
    """Per row: log joint of each component, log-sum-exp, responsibilities."""
    q = ("i00 * (x.r - m0) ^ 2 + i11 * (x.g - m1) ^ 2 + i22 * (x.b - m2) ^ 2 + 2 * i01 * (x.r - m0) * (x.g - m1) "
         "+ 2 * i02 * (x.r - m0) * (x.b - m2) + 2 * i12 * (x.g - m1) * (x.b - m2)")
    lj = f"ln(w) - 0.5 * (3 * ln(2 * pi()) + ld) - 0.5 * ({q})"
    return (f"{out}_j AS (SELECT x.rid, any_value(x.l_orderkey) AS l_orderkey, "
            f"any_value(x.l_linenumber) AS l_linenumber, any_value(x.rowkey) AS rowkey, any_value(x.r) AS r, "
            f"any_value(x.g) AS g, any_value(x.b) AS b, list({lj} ORDER BY p.k) AS lj "
            f"FROM col x, {inv} p GROUP BY x.rid),\n"
            f"{out} AS (SELECT *, list_max(lj) + ln(list_sum(list_transform(lj, lambda z: exp(z - list_max(lj))))) AS lse "
            f"FROM {out}_j)")


def _mstep_sql(e: str, out: str) -> str:
    sel = []
    for c in range(GMM_K):
        r = f"exp(lj[{c + 1}] - lse)"
        sel.append(f"SELECT {c} AS k, sum({r}) AS nk, sum({r} * r) AS s0, sum({r} * g) AS s1, sum({r} * b) AS s2, "
                   + ", ".join(f"sum({r} * {a} * {bb}) AS q{i}{j}" for i, a in enumerate(_AX)
                               for j, bb in enumerate(_AX) if j >= i) + f", count(*) AS n FROM {e}")
    st = f"{out}_s AS (" + " UNION ALL ".join(sel) + ")"
    par = (f"{out} AS (SELECT k, nk / n AS w, s0 / nk AS m0, s1 / nk AS m1, s2 / nk AS m2, "
           + ", ".join(f"q{i}{j} / nk - (s{i} / nk) * (s{j} / nk) AS c{i}{j}" for i in range(3)
                       for j in range(3) if j >= i) + f" FROM {out}_s)")
    return st + ",\n" + par


_GMM_BASE = f"{_COL_SQL},\n{_gmm_params0_sql()},\n{_inv_sql('par0', 'inv0')},\n{_lj_sql('inv0', 'e0')}"


@query("gmm_loglik", rows=("F12", "K12"), oracle=f"""
WITH {_GMM_BASE}
SELECT round(sum(lse), 3) AS loglik FROM e0
""")
def gmm_loglik(spark, sf_dir):
    """Mixture log likelihood Σ log Σ_k π_k N(x | μ_k, Σ_k) with a stable log-sum-exp."""
    c = colours(spark, sf_dir)
    w, m, cv = gmm_start(c)
    ll = GM.loglik_full(c, xs(), w, m, cv)
    return spark.createDataFrame([(round(ll, 3),)], "loglik double")


@query("gmm_responsibilities", rows=("F27", "K13"), oracle=f"""
WITH {_GMM_BASE}
SELECT l_orderkey, l_linenumber, list_transform(lj, lambda z: round(exp(z - lse), 6)) AS resp FROM e0
""")
def gmm_responsibilities(spark, sf_dir):
    """E-step: each row's responsibilities, from log densities (normalised in log space)."""
    c = colours(spark, sf_dir)
    w, m, cv = gmm_start(c)
    e = GM.e_step_columns(c, xs(), w, m, cv, ["l_orderkey", "l_linenumber"])
    return e.select("l_orderkey", "l_linenumber",
                    F.array(*[F.round(F.col(f"_r{j}"), 6) for j in range(GMM_K)]).alias("resp"))


EM_STEPS = 2


def _em_sql(steps: int) -> str:
    parts = [_GMM_BASE]
    for s in range(steps):
        parts.append(_mstep_sql(f"e{s}", f"par{s + 1}"))
        if s + 1 < steps:
            parts.append(_inv_sql(f"par{s + 1}", f"inv{s + 1}"))
            parts.append(_lj_sql(f"inv{s + 1}", f"e{s + 1}"))
    sel = " UNION ALL ".join(
        f"SELECT {s + 1} AS step, k, w, [m0, m1, m2] AS mean, [c00, c01, c02, c11, c12, c22] AS cov, "
        f"(SELECT sum(lse) FROM e{s}) AS ll FROM par{s + 1}" for s in range(steps))
    return ("WITH " + ",\n".join(parts) + f"\nSELECT step::BIGINT AS step, k::BIGINT AS component, round(w, 6) AS weight, "
            f"list_transform(mean, lambda x: round(x, 6)) AS mean, list_transform(cov, lambda x: round(x, 6)) AS cov, "
            f"round(ll, 3) AS loglik_before FROM ({sel})")


@query("gmm_em_step", rows=("K14", "K15"), oracle=_em_sql(EM_STEPS))
def gmm_em_step(spark, sf_dir):
    """Two EM iterations from the fixed start: soft counts, weights, means and covariances about
    the new means; each iteration is one aggregation over the rows."""
    c = colours(spark, sf_dir).persist()
    w, m, cv = gmm_start(c)
    rows = []
    for s in range(EM_STEPS):
        w, m, cv, ll = GM.em_step_full(c, xs(), w, m, cv)
        for k in range(GMM_K):
            cov6 = [cv[k][i][j] for i in range(3) for j in range(3) if j >= i]
            rows.append((s + 1, k, round(w[k], 6), [round(float(x), 6) for x in m[k]],
                         [round(float(x), 6) for x in cov6], round(ll, 3)))
    c.unpersist()
    return spark.createDataFrame(rows, "step bigint, component bigint, weight double, mean array<double>, "
                                       "cov array<double>, loglik_before double")


@query("gmm_top", rows=("K17",), oracle=f"""
WITH {_GMM_BASE},
h AS (SELECT l_orderkey, l_linenumber, rowkey, list_max(lj) AS score,
             list_position(lj, list_max(lj)) - 1 AS component FROM e0)
SELECT component::BIGINT AS component, rk::BIGINT AS rank, l_orderkey, l_linenumber, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY component ORDER BY round(score, 9) DESC, rowkey) AS rk FROM h)
WHERE rk <= 5
""")
def gmm_top(spark, sf_dir):
    """Hard assignment by the largest weight × density; the five highest-scoring rows of each
    component (top-k per group)."""
    c = colours(spark, sf_dir)
    w, m, cv = gmm_start(c)
    e = GM.e_step_columns(c, xs(), w, m, cv, ["l_orderkey", "l_linenumber", "rowkey"])
    # hard assignment: largest log joint, lowest component index on ties
    best = F.greatest(*[F.struct(F.col(f"_l{j}").alias("v"), F.lit(-j).alias("ni")) for j in range(GMM_K)])
    h = e.select("l_orderkey", "l_linenumber", "rowkey", best["v"].alias("score"),
                 (-best["ni"]).cast("bigint").alias("component"))
    top = NB.topk_per_group(h, "component", [F.desc(F.round("score", 9)), F.col("rowkey")], 5)
    return top.select("component", "rank", "l_orderkey", "l_linenumber",
                      F.round("score", 6).alias("score"))


# ------------------------------------------------------------------ diagonal EM on the vectors

def _diag_init(ev, assignment):
    """Shares, means and per-dimension variances (floored at 1e-8) of a hard assignment."""
    stat = Summarizer.metrics("mean", "variance")
    st = (assignment.select("cluster", array_to_vector("v").alias("x")).groupBy("cluster")
          .agg(F.count(F.lit(1)).alias("n"), stat.summary(F.col("x")).alias("s")).collect())        # one row per cluster
    n = {r["cluster"]: r["n"] for r in st}
    total = sum(n.values())
    ks = sorted(n)
    means = {r["cluster"]: r["s"]["mean"].toArray() for r in st}
    # the summary's variance divides by n - 1
    vars_ = {r["cluster"]: np.maximum(r["s"]["variance"].toArray() * (r["n"] - 1) / r["n"], 1e-8) for r in st}
    return ks, [n[k] / total for k in ks], [means[k] for k in ks], [vars_[k] for k in ks]


_DIAG_INIT_SQL = f"""
WITH {_EV}, {_C0}, {_assign_sql(0)},
st AS (SELECT k, i, avg(x) AS m, greatest(var_pop(x), 1e-8) AS var FROM
       (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a0) GROUP BY k, i),
sh AS (SELECT k, count(*) / (SELECT count(*) FROM ev) AS share FROM a0 GROUP BY k)"""


@query("gmm_diag_init", rows=("K18",), oracle=_DIAG_INIT_SQL + """
SELECT st.k AS cluster, round(any_value(share), 6) AS share, list(round(m, 6) ORDER BY i) AS mean,
       list(round(var, 9) ORDER BY i) AS variance FROM st JOIN sh USING (k) GROUP BY st.k
""")
def gmm_diag_init(spark, sf_dir):
    """EM start from a k-means assignment: shares, means, per-dimension variances ≥ 1e-8."""
    ev = vectors(spark, sf_dir)
    a = KM.assign(ev, "v", init_centroids(ev))
    ks, w, m, v = _diag_init(ev, a)
    rows = [(int(k), round(w[j], 6), [round(float(x), 6) for x in m[j]], [round(float(x), 9) for x in v[j]])
            for j, k in enumerate(ks)]
    return spark.createDataFrame(rows, "cluster bigint, share double, mean array<double>, variance array<double>")


@query("gmm_diag_step", rows=("K19",), oracle=_DIAG_INIT_SQL + """,
p AS (SELECT st.k, any_value(share) AS w, list(m ORDER BY i) AS mu, list(var ORDER BY i) AS var
      FROM st JOIN sh USING (k) GROUP BY st.k),
lj AS (SELECT e.vec_id, e.v, list(ln(p.w) - 0.5 * list_sum(list_transform(range(1, len(p.mu) + 1),
          lambda i: ln(2 * pi() * p.var[i]) + (e.v[i] - p.mu[i]) ^ 2 / p.var[i])) ORDER BY p.k) AS lj
       FROM ev e, p GROUP BY e.vec_id, e.v),
ls AS (SELECT *, list_max(lj) + ln(list_sum(list_transform(lj, lambda z: exp(z - list_max(lj))))) AS lse FROM lj),
r AS (SELECT vec_id, v, unnest(range(0, len(lj))) AS k, unnest(list_transform(lj, lambda z: exp(z - lse))) AS r FROM ls),
nw AS (SELECT k, sum(r) AS nk FROM r GROUP BY k),
x AS (SELECT k, r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM r),
mu2 AS (SELECT k, i, sum(r * x) / sum(r) AS m FROM x GROUP BY k, i),
va AS (SELECT k, i, any_value(m) AS m, greatest(sum(r * (x - m) ^ 2) / sum(r), 1e-8) AS var
       FROM x JOIN mu2 USING (k, i) GROUP BY k, i),
mv AS (SELECT k, list(round(m, 6) ORDER BY i) AS mean, list(round(var, 9) ORDER BY i) AS variance FROM va GROUP BY k)
SELECT k AS component, round(nk / (SELECT count(*) FROM ev), 6) AS weight, mean, variance,
       round((SELECT sum(lse) FROM ls), 3) AS loglik_before FROM nw JOIN mv USING (k)
""")
def gmm_diag_step(spark, sf_dir):
    """One diagonal-covariance EM step on the 64-d vectors from the k-means start: new weights,
    means and smoothed variances, and the log likelihood at the start."""
    ev = vectors(spark, sf_dir).persist()
    a = KM.assign(ev, "v", init_centroids(ev))
    ks, w, m, v = _diag_init(ev, a)
    nw, nm, nv, ll = GM.em_step_diag(ev, "v", w, m, v)
    ev.unpersist()
    rows = [(int(k), round(nw[j], 6), [round(float(x), 6) for x in nm[j]], [round(float(x), 9) for x in nv[j]],
             round(ll, 3)) for j, k in enumerate(ks)]
    return spark.createDataFrame(rows, "component bigint, weight double, mean array<double>, "
                                       "variance array<double>, loglik_before double")


EM_COMPARE = 10


@query("gmm_random_start", rows=("K16", "K20"))
def gmm_random_start(spark, sf_dir):
    """Diagonal EM from two starts, a k-means assignment and random rows with the columns'
    variances: log likelihood before each of ten steps."""
    ev = vectors(spark, sf_dir).persist()
    ks, w, m, v = _diag_init(ev, KM.assign(ev, "v", init_centroids(ev)))
    whole = _diag_init(ev, ev.withColumn("cluster", F.lit(0)))
    rand = init_centroids(ev, k=len(ks), seed=29)
    rows = []
    for name, (w, m, v) in {"kmeans": (w, m, v), "random": ([1 / len(ks)] * len(ks), list(rand), [whole[3][0]] * len(ks))}.items():
        for it in range(EM_COMPARE):
            w, m, v, ll = GM.em_step_diag(ev, "v", w, m, v)
            rows.append((name, it, float(ll)))
    ev.unpersist()
    return spark.createDataFrame(rows, "start string, iteration bigint, loglik double")
