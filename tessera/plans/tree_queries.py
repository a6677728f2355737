"""Decision-tree and AdaBoost queries.

Fixture (fixed values): lineitem ⋈ orders with 13 one-hot features
  rf_A rf_N rf_R (l_returnflag), ls_F ls_O (l_linestatus),
  op_1 .. op_5 (first character of o_orderpriority), os_F os_O os_P (o_orderstatus);
label = +1 when (l_returnflag = 'R' or o_orderpriority starts with 1 or 2), flipped where
cents % 7 = 0, else −1; split: md5(rowkey:1) % 1000 < 800 → train; weight = 1 + cents % 3.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators import binned_boost as BB
from tessera.operators import tree as T
from tessera.registry import query
from tessera.sources.tables import Tables

FEATURES = ["rf_A", "rf_N", "rf_R", "ls_F", "ls_O", "op_1", "op_2", "op_3", "op_4", "op_5",
            "os_F", "os_O", "os_P"]
_FEATURE_DEFS = [("rf_A", "l_returnflag", "A"), ("rf_N", "l_returnflag", "N"),
                 ("rf_R", "l_returnflag", "R"), ("ls_F", "l_linestatus", "F"),
                 ("ls_O", "l_linestatus", "O"), ("op_1", "prio", "1"), ("op_2", "prio", "2"),
                 ("op_3", "prio", "3"), ("op_4", "prio", "4"), ("op_5", "prio", "5"),
                 ("os_F", "o_orderstatus", "F"), ("os_O", "o_orderstatus", "O"),
                 ("os_P", "o_orderstatus", "P")]


def tree_frame(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_returnflag", "l_linestatus",
                           F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    o = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("prio"),
                        "o_orderstatus")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    rowkey = F.concat_ws(":", *[F.col(c).cast("string") for c in
                                ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents")],
                         F.col("l_quantity").cast("bigint").cast("string"))
    rule = (F.col("l_returnflag") == "R") | F.col("prio").isin("1", "2")
    flip = (F.col("cents") % 7) == 0
    return j.select(*[(F.col(c) == v).cast("bigint").alias(n) for n, c, v in _FEATURE_DEFS],
                    "prio", F.when(rule != flip, 1).otherwise(-1).cast("bigint").alias("y"),
                    (1 + F.col("cents") % 3).cast("double").alias("w"),
                    F.when(bucket(rowkey, 1) < 800, "train").otherwise("test").alias("split"))


TREE_SQL = f"""base AS (
  SELECT {', '.join(f"({c} = '{v}')::BIGINT AS {n}" for n, c, v in _FEATURE_DEFS)}, prio,
         (CASE WHEN (l_returnflag = 'R' OR prio IN ('1', '2')) <> (cents % 7 = 0) THEN 1 ELSE -1 END)::BIGINT AS y,
         (1 + cents % 3)::DOUBLE AS w,
         CASE WHEN {sql_hash32('rowkey', 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, l_quantity::BIGINT)
                  AS rowkey
        FROM (SELECT l.*, round(l_extendedprice * 100)::BIGINT AS cents, substr(o_orderpriority, 1, 1) AS prio,
                     o_orderstatus
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)))"""


def tree_sql(src: str, max_depth: int, weighted: bool = False, min_node_size: float = 0,
             min_error_reduction: float | None = None, p: str = "t") -> tuple[str, str, str]:
    """Oracle: the same level-wise tree as unrolled SQL CTEs. Returns (ctes, nodes, assign)."""
    d = len(FEATURES)
    w = "w" if weighted else "1"
    xs = "[" + ", ".join(FEATURES) + "]"
    names = "[" + ", ".join(f"'{n}'" for n in FEATURES) + "]"
    ctes = [f"{p}a0 AS (SELECT *, 1::BIGINT AS node FROM {src})",
            f"{p}m0 AS (SELECT 1::BIGINT AS node, 0::BIGINT AS mask)"]
    for k in range(max_depth + 1):
        sums = []
        for i, c in enumerate(FEATURES):
            for v in (0, 1):
                for lab, nm in ((1, "p"), (-1, "q")):
                    sums.append(f"sum(CASE WHEN {c} = {v} AND y = {lab} THEN {w} ELSE 0 END) AS {nm}{v}_{i}")
        ctes.append(f"{p}s{k} AS (SELECT node, {', '.join(sums)} FROM {p}a{k} "
                    f"WHERE split = 'train' AND node IN (SELECT node FROM {p}m{k}) GROUP BY node)")
        m_after = "[" + ", ".join(f"least(p0_{i}, q0_{i}) + least(p1_{i}, q1_{i})" for i in range(d)) + "]"
        nl = "[" + ", ".join(f"p0_{i} + q0_{i}" for i in range(d)) + "]"
        nr = "[" + ", ".join(f"p1_{i} + q1_{i}" for i in range(d)) + "]"
        ctes.append(f"{p}c{k} AS (SELECT s.node, m.mask, p0_0 + p1_0 AS P, q0_0 + q1_0 AS Q, "
                    f"unnest(range(0, {d})) AS f, unnest({m_after}) AS m_after, unnest({nl}) AS nl, "
                    f"unnest({nr}) AS nr FROM {p}s{k} s JOIN {p}m{k} m USING (node))")
        ctes.append(f"{p}b{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node "
                    f"ORDER BY m_after, f) AS rk FROM {p}c{k} WHERE ((mask >> f) & 1) = 0) WHERE rk = 1)")
        pure = "least(t.P, t.Q) <= 1e-15" if weighted else "least(t.P, t.Q) = 0"
        pred = ("CASE WHEN t.P < t.Q THEN -1 ELSE 1 END" if weighted
                else "CASE WHEN t.P > t.Q THEN 1 ELSE -1 END")
        stops = [pure, "b.f IS NULL", f"{k} >= {max_depth}", f"(t.P + t.Q) <= {min_node_size}"]
        if min_error_reduction is not None:
            stops.append(f"(least(t.P, t.Q) - b.m_after) / (t.P + t.Q) <= {min_error_reduction}")
        stops += ["b.nl = 0", "b.nr = 0"]
        ctes.append(f"{p}d{k} AS (SELECT t.node, {k} AS depth, t.P, t.Q, t.mask, b.f AS best_f, "
                    f"({' OR '.join('(' + s + ')' for s in stops)}) AS leaf, {pred} AS pred "
                    f"FROM (SELECT DISTINCT node, P, Q, mask FROM {p}c{k}) t LEFT JOIN {p}b{k} b USING (node))")
        ctes.append(f"{p}a{k + 1} AS (SELECT a.* EXCLUDE (node), CASE WHEN d.node IS NOT NULL AND NOT d.leaf "
                    f"THEN 2 * a.node + list_extract({xs}, d.best_f + 1) ELSE a.node END AS node "
                    f"FROM {p}a{k} a LEFT JOIN {p}d{k} d ON a.node = d.node)")
        ctes.append(f"{p}m{k + 1} AS (SELECT 2 * node + v AS node, mask | (1::BIGINT << best_f) AS mask "
                    f"FROM {p}d{k}, (VALUES (0), (1)) vv(v) WHERE NOT leaf)")
    ctes.append(f"{p}nodes AS (" + " UNION ALL ".join(
        f"SELECT node, depth, CASE WHEN leaf THEN NULL ELSE list_extract({names}, best_f + 1) END AS feature, "
        f"CASE WHEN leaf THEN pred END AS prediction, P + Q AS n, least(P, Q) AS mistakes FROM {p}d{k}"
        for k in range(max_depth + 1)) + ")")
    return ",\n".join(ctes), f"{p}nodes", f"{p}a{max_depth + 1}"


def _nodes_df(spark, tree, weighted=False):
    rows = []
    for k, depth, feat, pred, n, m in T.tree_rows(tree, FEATURES):
        if weighted:
            rows.append((k, depth, feat, pred, round(n, 6), round(m, 6)))
        else:
            rows.append((k, depth, feat, pred, int(n), int(m)))
    t = "double" if weighted else "bigint"
    return spark.createDataFrame(rows, f"node bigint, depth bigint, feature string, prediction bigint, "
                                       f"n {t}, mistakes {t}")


def _nodes_sql(nodes: str, weighted=False) -> str:
    if weighted:
        return (f"SELECT node, depth::BIGINT AS depth, feature, prediction::BIGINT AS prediction, "
                f"round(n, 6) AS n, round(mistakes, 6) AS mistakes FROM {nodes}")
    return (f"SELECT node, depth::BIGINT AS depth, feature, prediction::BIGINT AS prediction, "
            f"n::BIGINT AS n, mistakes::BIGINT AS mistakes FROM {nodes}")


# ------------------------------------------------------------------ node statistics

@query("node_mistakes", rows=("C20",), oracle=f"""
WITH {TREE_SQL}
SELECT prio, least(count_if(y = 1), count_if(y = -1))::BIGINT AS mistakes, count(*)::BIGINT AS n
FROM base WHERE split = 'train' GROUP BY prio
""")
def node_mistakes(spark, sf_dir):
    """Mistakes of the majority-class prediction in each node (here: each priority group)."""
    d = tree_frame(spark, sf_dir).where(F.col("split") == "train")
    return d.groupBy("prio").agg(
        F.least(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == -1)).cast("bigint")
        .alias("mistakes"), F.count(F.lit(1)).alias("n"))


@query("weighted_node_mistakes", rows=("C30",), oracle=f"""
WITH {TREE_SQL},
g AS (SELECT prio, sum(w) FILTER (WHERE y = 1) AS wp, sum(w) FILTER (WHERE y = -1) AS wn
      FROM base WHERE split = 'train' GROUP BY prio)
SELECT prio, round(CASE WHEN wp < wn THEN wp ELSE wn END, 6) AS weighted_mistakes,
       (CASE WHEN wp < wn THEN -1 ELSE 1 END)::BIGINT AS prediction FROM g
""")
def weighted_node_mistakes(spark, sf_dir):
    """Weighted mistakes and class per node: predict −1 only when the +1 weight is smaller
    (ties → +1)."""
    d = tree_frame(spark, sf_dir).where(F.col("split") == "train")
    g = d.groupBy("prio").agg(F.sum(F.when(F.col("y") == 1, F.col("w"))).alias("wp"),
                              F.sum(F.when(F.col("y") == -1, F.col("w"))).alias("wn"))
    neg = F.col("wp") < F.col("wn")
    return g.select("prio", F.round(F.when(neg, F.col("wp")).otherwise(F.col("wn")), 6)
                    .alias("weighted_mistakes"),
                    F.when(neg, -1).otherwise(1).cast("bigint").alias("prediction"))


@query("best_split", rows=("C21",), oracle=f"""
WITH {TREE_SQL},
s AS (SELECT {', '.join(f"count_if({c} = 0 AND y = 1) AS p0_{i}, count_if({c} = 0 AND y = -1) AS q0_{i}, "
                        f"count_if({c} = 1 AND y = 1) AS p1_{i}, count_if({c} = 1 AND y = -1) AS q1_{i}"
                        for i, c in enumerate(FEATURES))}, count(*) AS n FROM base WHERE split = 'train'),
c AS (SELECT unnest(range(0, {len(FEATURES)})) AS f,
             unnest([{', '.join(f"least(p0_{i}, q0_{i}) + least(p1_{i}, q1_{i})" for i in range(len(FEATURES)))}]) AS m,
             n FROM s)
SELECT list_extract([{', '.join(f"'{n}'" for n in FEATURES)}], f + 1) AS feature, m::BIGINT AS mistakes,
       round(m / n, 9) AS error, row_number() OVER (ORDER BY m, f) = 1 AS best FROM c
""")
def best_split(spark, sf_dir):
    """Classification error of splitting the root on each binary feature; first feature
    wins ties. One aggregation of 4·d conditional counts."""
    d = tree_frame(spark, sf_dir).where(F.col("split") == "train")
    best, per, total = T.best_root_split(d, FEATURES, "y")
    rows = [(FEATURES[i], int(per[i]), round(per[i] / total, 9), i == best)
            for i in range(len(FEATURES))]
    return spark.createDataFrame(rows, "feature string, mistakes bigint, error double, best boolean")


# ------------------------------------------------------------------ trees

TREE_DEPTH = 6
_T_CTES, _T_NODES, _T_ASSIGN = tree_sql("base", TREE_DEPTH)


@query("tree_levelwise", rows=("C22", "C23", "C26"), oracle=f"""
WITH {TREE_SQL},
{_T_CTES}
{_nodes_sql(_T_NODES)}
""")
def tree_levelwise(spark, sf_dir):
    """Depth-6 classification-error tree on the training rows, one aggregation per level;
    the node table (node, depth, split feature, leaf prediction, n, mistakes)."""
    d = tree_frame(spark, sf_dir).where(F.col("split") == "train").persist()
    tree = T.build_tree(d, FEATURES, "y", TREE_DEPTH)
    d.unpersist()
    return _nodes_df(spark, tree)


@query("tree_predict", rows=("C24", "C25"), oracle=f"""
WITH {TREE_SQL},
{_T_CTES}
SELECT a.split, round(avg(CASE WHEN n.prediction = a.y THEN 0.0 ELSE 1.0 END), 6) AS error,
       count(*)::BIGINT AS n
FROM {_T_ASSIGN} a JOIN {_T_NODES} n ON a.node = n.node GROUP BY a.split
""")
def tree_predict(spark, sf_dir):
    """Classify every row with the depth-6 tree (a nested CASE, one test per level); error by split."""
    d = tree_frame(spark, sf_dir).persist()
    tree = T.build_tree(d.where(F.col("split") == "train"), FEATURES, "y", TREE_DEPTH)
    pred = T.predict_column(tree, FEATURES)
    res = d.groupBy("split").agg(
        F.round(F.avg((pred != F.col("y")).cast("double")), 6).alias("error"),
        F.count(F.lit(1)).alias("n"))
    res = spark.createDataFrame(res.collect(), res.schema)   # two rows; then release the cache
    d.unpersist()
    return res


EARLY_STOP = [("depth_2", 2, 0, None), ("depth_6", 6, 0, None), ("depth_14", 14, 0, None),
              ("depth_14_min_size_50000", 14, 50000, None),
              ("depth_6_min_size_2000", 6, 2000, None), ("depth_6_min_reduction_0", 6, 0, 0.0),
              ("depth_6_min_reduction_5", 6, 0, 5.0)]


def _early_sql():
    ctes, sels = [], []
    for j, (name, depth, size, red) in enumerate(EARLY_STOP):
        c, nodes, assign = tree_sql("base", depth, min_node_size=size, min_error_reduction=red,
                                    p=f"e{j}")
        ctes.append(c)
        sels.append(f"""SELECT '{name}' AS config,
  (SELECT count(*) FROM {nodes} WHERE prediction IS NOT NULL)::BIGINT AS n_leaves,
  (SELECT round(avg(CASE WHEN n.prediction = a.y THEN 0.0 ELSE 1.0 END), 6) FROM {assign} a
     JOIN {nodes} n ON a.node = n.node WHERE a.split = 'train') AS train_error,
  (SELECT round(avg(CASE WHEN n.prediction = a.y THEN 0.0 ELSE 1.0 END), 6) FROM {assign} a
     JOIN {nodes} n ON a.node = n.node WHERE a.split = 'test') AS test_error""")
    return f"WITH {TREE_SQL},\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sels)


@query("tree_early_stop", rows=("C27", "C28"), oracle=_early_sql())
def tree_early_stop(spark, sf_dir):
    """Early-stopping sweep (max depth, minimum node size, minimum error reduction): number of
    leaves and train/test error of each tree; every tree's errors in one scoring pass."""
    d = tree_frame(spark, sf_dir).persist()
    train = d.where(F.col("split") == "train")
    trees = T.build_trees(train, FEATURES, "y", {
        name: {"max_depth": depth, "min_node_size": size, "min_error_reduction": red}
        for name, depth, size, red in EARLY_STOP})     # all trees share each level's pass
    aggs = []
    for j, (name, tree) in enumerate(trees.items()):
        pred = T.predict_column(tree, FEATURES)
        aggs.append(F.avg((pred != F.col("y")).cast("double")).alias(f"e{j}"))
    errs = {r["split"]: r for r in d.groupBy("split").agg(*aggs).collect()}
    d.unpersist()
    rows = [(name, sum(1 for nd in tree.values() if nd.prediction is not None),
             round(errs["train"][f"e{j}"], 6), round(errs["test"][f"e{j}"], 6))
            for j, (name, tree) in enumerate(trees.items())]
    return spark.createDataFrame(rows, "config string, n_leaves bigint, train_error double, "
                                       "test_error double")


WTREE_DEPTH = 2
_W_CTES, _W_NODES, _ = tree_sql("base", WTREE_DEPTH, weighted=True, p="w")


@query("weighted_split", rows=("P13", "C31", "C32"), oracle=f"""
WITH {TREE_SQL},
{_W_CTES}
{_nodes_sql(_W_NODES, weighted=True)}
""")
def weighted_split(spark, sf_dir):
    """Weighted tree (row weight = data weight column, best split by weighted mistakes)."""
    d = tree_frame(spark, sf_dir).where(F.col("split") == "train").persist()
    tree = T.build_tree(d, FEATURES, "y", WTREE_DEPTH, weight=F.col("w"))
    d.unpersist()
    return _nodes_df(spark, tree, weighted=True)


# ------------------------------------------------------------------ AdaBoost

def binned_frame(spark, sf_dir) -> BB.Binned:
    """The fixture as counts of its different (features, label, split)."""
    d = tree_frame(spark, sf_dir).select(*FEATURES, ((F.col("y") + 1) / 2).cast("bigint").alias("y"), (F.col("split") == "test").cast("bigint").alias("test"))
    return BB.binned(d, FEATURES, [2] * len(FEATURES), "y", "test")


def _ada_sql(rounds: int) -> str:
    ctes = ["r0 AS (SELECT *, 0.0::DOUBLE AS F FROM base)"]
    sels = []
    d = len(FEATURES)
    xs = "[" + ", ".join(FEATURES) + "]"
    for t in range(1, rounds + 1):
        sums = []
        for i, c in enumerate(FEATURES):
            for v in (0, 1):
                for lab, nm in ((1, "p"), (-1, "q")):
                    sums.append(f"sum(CASE WHEN {c} = {v} AND y = {lab} THEN exp(-y * F) ELSE 0 END) AS {nm}{v}_{i}")
        ctes.append(f"s{t} AS (SELECT {', '.join(sums)} FROM r{t - 1} WHERE split = 'train')")
        ctes.append(f"c{t} AS (SELECT unnest(range(0, {d})) AS f, unnest([" +
                    ", ".join(f"least(p0_{i}, q0_{i}) + least(p1_{i}, q1_{i})" for i in range(d)) +
                    "]) AS m, unnest([" + ", ".join(f"CASE WHEN p0_{i} < q0_{i} THEN -1 ELSE 1 END" for i in range(d)) +
                    "]) AS lp, unnest([" + ", ".join(f"CASE WHEN p1_{i} < q1_{i} THEN -1 ELSE 1 END" for i in range(d)) +
                    f"]) AS rp, p0_0 + q0_0 + p1_0 + q1_0 AS tot FROM s{t})")
        ctes.append(f"b{t} AS (SELECT f, lp, rp, m / tot AS err, 0.5 * ln((1 - m / tot) / (m / tot)) AS alpha "
                    f"FROM c{t} ORDER BY m, f LIMIT 1)")
        ctes.append(f"r{t} AS (SELECT r.* EXCLUDE (F), r.F + b.alpha * (CASE WHEN list_extract({xs}, b.f + 1) = 0 "
                    f"THEN b.lp ELSE b.rp END) AS F FROM r{t - 1} r, b{t} b)")
        sels.append(t)
    return ctes, sels


ADA_ROUNDS = 3
_names_sql = "[" + ", ".join(f"'{n}'" for n in FEATURES) + "]"
_ada_ctes, _ = _ada_sql(ADA_ROUNDS)


@query("adaboost", rows=("C33", "C34"), oracle=f"""
WITH {TREE_SQL},
{', '.join(_ada_ctes)}
""" + "\nUNION ALL\n".join(
    f"SELECT {t}::BIGINT AS round, list_extract({_names_sql}, f + 1) AS feature, lp::BIGINT AS left_prediction, "
    f"rp::BIGINT AS right_prediction, round(err, 9) AS weighted_error, round(alpha, 9) AS alpha FROM b{t}"
    for t in range(1, ADA_ROUNDS + 1)))
def adaboost(spark, sf_dir):
    """Three AdaBoost rounds on stumps: feature, leaf predictions, weighted error and
    α = ½·ln((1 − e)/e) of each."""
    data = binned_frame(spark, sf_dir)
    stumps, _ = BB.adaboost(data, ADA_ROUNDS)
    data.close()
    rows = [(t + 1, FEATURES[f], l, r, round(e, 9), round(a, 9))
            for t, (f, l, r, e, a) in enumerate(stumps)]
    return spark.createDataFrame(rows, "round bigint, feature string, left_prediction bigint, "
                                       "right_prediction bigint, weighted_error double, alpha double")


STAGED_ROUNDS = 30
_st_ctes, _ = _ada_sql(STAGED_ROUNDS)


@query("adaboost_staged", rows=("W5", "C35"), oracle=f"""
WITH {TREE_SQL},
{', '.join(_st_ctes)},
staged AS (""" + "\nUNION ALL\n".join(
    f"SELECT {t} AS t, split, CASE WHEN (CASE WHEN F > 0 THEN 1 ELSE -1 END) = y THEN 0.0 ELSE 1.0 END AS wrong "
    f"FROM r{t}" for t in range(1, STAGED_ROUNDS + 1)) + """)
SELECT t::BIGINT AS n_stumps, split, round(avg(wrong), 6) AS error FROM staged GROUP BY t, split
""")
def adaboost_staged(spark, sf_dir):
    """Train and test error of the ensemble of the first t stumps, t = 1..30 (sign, 0 → −1): the
    data is read once, as counts of its different rows, which every round weighs anew."""
    data = binned_frame(spark, sf_dir)
    _, errors = BB.adaboost(data, STAGED_ROUNDS)
    data.close()
    rows = [(t + 1, split, round(float(e), 6)) for t, both in enumerate(errors) for split, e in zip(("train", "test"), both) if e is not None]
    return spark.createDataFrame(rows, "n_stumps bigint, split string, error double")


# ------------------------------------------------------------------ gradient boosting

GBT_TREES, GBT_DEPTH, GBT_RATE, GBT_PENALTY, GBT_STUMPS = 500, 6, 0.3, 1.0, 4


def _gbt_sql(rounds: int) -> str:
    d, parts = len(FEATURES), ["g0 AS (SELECT *, (y + 1) / 2 AS t, 0.0::DOUBLE AS m FROM base)"]
    names = "[" + ", ".join(f"'{n}'" for n in FEATURES) + "]"
    xs = "[" + ", ".join(FEATURES) + "]"
    for r in range(1, rounds + 1):
        sums = ", ".join(f"sum(CASE WHEN {c} = 0 THEN g ELSE 0 END) AS gl_{i}, sum(CASE WHEN {c} = 0 THEN h ELSE 0 END) AS hl_{i}" for i, c in enumerate(FEATURES))
        parts.append(f"""h{r} AS (SELECT sum(g) AS gs, sum(h) AS hs, {sums} FROM (SELECT *, 1 / (1 + exp(-m)) - t AS g,
  (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) AS h FROM g{r - 1} WHERE split = 'train')),
f{r} AS (SELECT f, gl, hl, gs, hs, gl ^ 2 / (hl + {GBT_PENALTY}) + (gs - gl) ^ 2 / (hs - hl + {GBT_PENALTY}) - gs ^ 2 / (hs + {GBT_PENALTY}) AS gain FROM (
  SELECT gs, hs, unnest(range({d})) AS f, unnest([{', '.join(f'gl_{i}' for i in range(d))}]) AS gl, unnest([{', '.join(f'hl_{i}' for i in range(d))}]) AS hl FROM h{r})
  WHERE hl > 1e-12 AND hs - hl > 1e-12),
b{r} AS (SELECT f, -{GBT_RATE} * gl / (hl + {GBT_PENALTY}) AS lv, -{GBT_RATE} * (gs - gl) / (hs - hl + {GBT_PENALTY}) AS rv FROM f{r}
  WHERE gain >= (SELECT max(gain) FROM f{r}) * (1 - 1e-9) ORDER BY f LIMIT 1),
g{r} AS (SELECT g.* EXCLUDE (m), m + CASE WHEN list_extract({xs}, b.f + 1) = 0 THEN b.lv ELSE b.rv END AS m FROM g{r - 1} g, b{r} b)""")
    out = "\nUNION ALL\n".join(
        f"SELECT {r}::BIGINT AS n_trees, list_extract({names}, (SELECT f FROM b{r}) + 1) AS feature, round((SELECT lv FROM b{r}), 9) AS left_value, "
        f"round((SELECT rv FROM b{r}), 9) AS right_value, round(avg(CASE WHEN split = 'train' THEN ((m > 0) <> (t = 1))::INT END), 6) AS train_error, "
        f"round(avg(CASE WHEN split = 'test' THEN ((m > 0) <> (t = 1))::INT END), 6) AS test_error FROM g{r}" for r in range(1, rounds + 1))
    return f"WITH {TREE_SQL},\n" + ",\n".join(parts) + "\n" + out


@query("gbt_stumps", rows=("C29",), oracle=_gbt_sql(GBT_STUMPS))
def gbt_stumps(spark, sf_dir):
    """The first four trees of depth 1 of the gradient boosting: cut, leaf values and errors."""
    data = binned_frame(spark, sf_dir)
    trees, errors = BB.boost(data, GBT_STUMPS, 1, GBT_RATE, GBT_PENALTY)
    data.close()
    rows = [(i + 1, FEATURES[t.feature[1]], round(float(t.value[2]), 9), round(float(t.value[3]), 9),
             *[None if e is None else round(float(e), 6) for e in both]) for i, (t, both) in enumerate(zip(trees, errors[1:]))]
    return spark.createDataFrame(rows, "n_trees bigint, feature string, left_value double, right_value double, train_error double, test_error double")


@query("gbt_staged", rows=("C29",))
def gbt_staged(spark, sf_dir):
    """Gradient-boosted trees of depth 6: train and test error after every number of trees from 1
    to 500, in one run (no refit per size)."""
    data = binned_frame(spark, sf_dir)
    _, errors = BB.boost(data, GBT_TREES, GBT_DEPTH, GBT_RATE, GBT_PENALTY)
    data.close()
    rows = [(i, *[None if e is None else float(e) for e in both]) for i, both in enumerate(errors) if i]
    return spark.createDataFrame(rows, "n_trees bigint, train_error double, test_error double")
