"""Dense similarity search, vector math and LSH queries.

Corpus: ``embeddings`` with each vector scaled by (1 + vec_id % 3), so Euclidean
and cosine orders differ. Queries: the vectors whose id is divisible by 50 against all rows,
themselves included (as the first hit), in blocks; a task sends on only the nearest rows of
each query. Vector arithmetic meets the mean vector of each label.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import kmeans as KM
from tessera.operators import lsh as L
from tessera.operators import neighbors as NB
from tessera.operators import packed_search as PS
from tessera.operators import sparse_rows as SR
from tessera.operators.block_search import search
from tessera.registry import query
from tessera.session import written
from tessera.sources.tables import Tables, spread

K_DENSE = 5
LSH_BITS, LSH_SEED, LSH_RADIUS = 16, 42, 2
EVERY, MAX_LABELS = 50, 4096
SWEEP_BITS, SWEEP_SEED = 19, 43


def scaled_embeddings(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    w = V.scale(V.to_double("embedding"), (F.lit(1) + F.col("vec_id") % 3).cast("double"))
    return spread(e.select("vec_id", F.col("label").cast("bigint").alias("label"), w.alias("w")))


def label_centroids(ev):
    """Mean vector per label as a small frame (query_id, c), from vector sums added up in the tasks.
    Means are rounded to 9 places, so that the order of summation does not reach what is derived
    from them. At most ``MAX_LABELS`` labels."""
    labels = [r["label"] for r in NB.collect_bounded(ev.select("label").distinct(), MAX_LABELS)]
    sums = KM.cluster_sums(ev.where(F.col("label").isNotNull()), "w", F.col("label"))
    data = [(int(lab), [round(float(x), 9) for x in sums[lab][1] / sums[lab][0]]) for lab in sorted(x for x in labels if x is not None)]
    return ev.sparkSession.createDataFrame(data, "query_id bigint, c array<double>")


def asked(ev):
    """The query vectors as (query_id, vec)."""
    return ev.where(F.col("vec_id") % EVERY == 0).select(F.col("vec_id").alias("query_id"), F.col("w").alias("vec"))


def packed_units(ev, n_bits: int, seed: int):
    """Unit vectors packed with their signatures, and the query rows."""
    planes = L.hyperplanes(n_bits, 64, seed)
    rows = ev.select(F.col("vec_id").alias("id"), F.sequence(F.lit(0), F.size("w") - 1).alias("cols"),
                     V.l2_normalize("w").alias("vals"), L.signature("w", planes).cast("double").alias("extra"))
    return SR.pack(rows), rows.where(F.col("id") % EVERY == 0)


_EV_SQL = """
ev AS (SELECT vec_id, label::BIGINT AS label,
              list_transform(embedding, lambda x: x::DOUBLE * (1 + vec_id % 3)) AS w FROM embeddings),
cent AS (SELECT label AS query_id, list(a ORDER BY i) AS c FROM (
           SELECT label, i, round(avg(x), 9) AS a FROM (
             SELECT label, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM ev) GROUP BY 1, 2)
         GROUP BY 1),
qs AS (SELECT vec_id AS query_id, w AS c FROM ev WHERE vec_id % 50 = 0)"""

_EUCLID_SQL = "sqrt(list_sum(list_transform(range(1, len(c.c) + 1), lambda i: (e.w[i] - c.c[i]) ^ 2)))"
_COSINE_SQL = ("1 - list_sum(list_transform(range(1, len(c.c) + 1), lambda i: e.w[i] * c.c[i])) / "
               "(sqrt(list_sum(list_transform(e.w, lambda x: x * x))) * "
               "sqrt(list_sum(list_transform(c.c, lambda x: x * x))))")


def _knn_sql(dist_sql: str, k: int) -> str:
    return f"""
WITH {_EV_SQL},
d AS (SELECT c.query_id, e.vec_id, {dist_sql} AS dist FROM ev e, qs c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), vec_id) AS rk FROM d)
SELECT query_id, vec_id, rk::BIGINT AS rank, round(dist, 6) AS distance FROM r WHERE rk <= {k}
"""


def _dense(spark, sf_dir, metric, k):
    ev = scaled_embeddings(spark, sf_dir)
    corpus = ev.select(F.col("vec_id").alias("row"), F.lit(0).alias("label"), F.col("w").alias("vec"))
    return search(corpus, asked(ev), k, metric=metric).withColumnRenamed("row", "vec_id")


@query("knn_euclid", oracle=_knn_sql(_EUCLID_SQL, K_DENSE), rows=("J6", "W1", "F19", "N1"))
def knn_euclid(spark, sf_dir):
    """5 nearest vectors (Euclidean) of each query vector; rank 1 = nearest."""
    r = _dense(spark, sf_dir, "euclidean", K_DENSE)
    return r.select("query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


@query("knn_cosine", oracle=_knn_sql(_COSINE_SQL, K_DENSE), rows=("F20", "N2", "M9"))
def knn_cosine(spark, sf_dir):
    r = _dense(spark, sf_dir, "cosine", K_DENSE)
    return r.select("query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


@query("nn_mean_distance", rows=("N4",), oracle=f"""
SELECT query_id, round(avg(dist), 6) AS mean_distance FROM (
  WITH {_EV_SQL},
  d AS (SELECT c.query_id, e.vec_id, {_EUCLID_SQL} AS dist FROM ev e, qs c)
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), vec_id) AS rk FROM d)
WHERE rk <= {K_DENSE} GROUP BY query_id
""")
def nn_mean_distance(spark, sf_dir):
    r = _dense(spark, sf_dir, "euclidean", K_DENSE)
    return r.groupBy("query_id").agg(F.round(F.avg("distance"), 6).alias("mean_distance"))


@query("l2_normalize", rows=("F21",), oracle=f"""
WITH {_EV_SQL}
SELECT vec_id, list_transform(w, lambda x: round(x / sqrt(list_sum(list_transform(w, lambda y: y * y))), 6))
       AS unit FROM ev
""")
def l2_normalize(spark, sf_dir):
    ev = scaled_embeddings(spark, sf_dir)
    return ev.select("vec_id", F.transform(V.l2_normalize("w"), lambda x: F.round(x, 6)).alias("unit"))


@query("vec_dot_norm", rows=("F16",), oracle=f"""
WITH {_EV_SQL}
SELECT e.vec_id, round(list_sum(list_transform(range(1, len(c.c) + 1), lambda i: e.w[i] * c.c[i])), 6) AS dot,
       round(sqrt(list_sum(list_transform(e.w, lambda x: x * x))), 6) AS norm
FROM ev e JOIN cent c ON e.label = c.query_id
""")
def vec_dot_norm(spark, sf_dir):
    """Dot product of each vector with its label's mean vector, and its 2-norm."""
    ev = scaled_embeddings(spark, sf_dir)
    cent = label_centroids(ev).withColumnRenamed("query_id", "label")
    return (ev.join(F.broadcast(cent), "label")   # labels × d, collected under a bound
            .select("vec_id", F.round(V.dot("w", "c"), 6).alias("dot"),
                    F.round(V.norm("w"), 6).alias("norm")))


@query("vec_elementwise", rows=("F17", "F28"), oracle=f"""
WITH {_EV_SQL}
SELECT e.vec_id,
  list_transform(range(1, len(c.c) + 1),
    lambda i: round((e.w[i] + c.c[i]) * (e.w[i] - c.c[i]) / 2 + pow(e.w[i], 2), 6) + 0.0) AS combo,
  list_transform(list_reverse_sort(e.w), lambda x: round(x, 6) + 0.0) AS sorted_desc
FROM ev e JOIN cent c ON e.label = c.query_id
""")
def vec_elementwise(spark, sf_dir):
    """Element-wise +, -, ×, ÷ and power with the label mean; values sorted descending."""
    ev = scaled_embeddings(spark, sf_dir)
    cent = label_centroids(ev).withColumnRenamed("query_id", "label")
    combo = V.add(V.div(V.mul(V.add("w", "c"), V.sub("w", "c")),
                        F.array_repeat(F.lit(2.0), F.size("w"))), V.power("w", 2))
    return (ev.join(F.broadcast(cent), "label")
            .select("vec_id", F.transform(combo, lambda x: F.round(x, 6) + F.lit(0.0)).alias("combo"),
                    F.transform(F.sort_array("w", asc=False), lambda x: F.round(x, 6) + F.lit(0.0))
                    .alias("sorted_desc")))


@query("matmul_coo", rows=("F18",), oracle=f"""
WITH {_EV_SQL},
a AS (SELECT vec_id, unnest(w) AS v, generate_subscripts(w, 1) - 1 AS dim FROM ev),
b AS (SELECT query_id AS label, unnest(c) AS v, generate_subscripts(c, 1) - 1 AS dim FROM cent)
SELECT a.vec_id, b.label, round(sum(a.v * b.v), 6) AS value FROM a JOIN b USING (dim)
GROUP BY a.vec_id, b.label
""")
def matmul_coo(spark, sf_dir):
    """Matrix product on (row, col, value) triples: join on the inner index, sum per cell."""
    ev = scaled_embeddings(spark, sf_dir)
    a = ev.select("vec_id", F.posexplode("w").alias("dim", "v"))
    cent = label_centroids(ev)
    b = cent.select(F.col("query_id").alias("label"), F.posexplode("c").alias("dim", "bv"))
    # b has labels × d rows (collected under a bound): broadcast, so the few `dim` keys never skew
    return (a.join(F.broadcast(b), "dim").groupBy("vec_id", "label")
            .agg(F.round(F.sum(F.col("v") * F.col("bv")), 6).alias("value")))


# ---------------------------------------------------------------- LSH

def _bins_sql(n_bits, seed, table="ev", vec="w", key="vec_id", name="eb"):
    return f"""planes_{name} AS ({L.planes_sql(n_bits, 64, seed)}),
{name} AS (SELECT e.{key}, sum(CASE WHEN list_sum(list_transform(range(1, len(p.p) + 1),
                 lambda i: e.{vec}[i] * p.p[i])) >= 0 THEN (1::BIGINT << ({n_bits - 1} - p.j)) ELSE 0 END)::BIGINT AS bin
     FROM {table} e, planes_{name} p GROUP BY e.{key})"""


def _with_bins(df, vec, n_bits, seed, dim):
    return df.withColumn("bin", L.signature(vec, L.hyperplanes(n_bits, dim, seed)))


@query("lsh_bins", rows=("F24", "N7"), oracle=f"""
WITH {_EV_SQL},
{_bins_sql(LSH_BITS, LSH_SEED)}
SELECT vec_id, bin FROM eb
""")
def lsh_bins(spark, sf_dir):
    ev = scaled_embeddings(spark, sf_dir)
    return _with_bins(ev, "w", LSH_BITS, LSH_SEED, 64).select("vec_id", "bin")


@query("lsh_bit_agreement", rows=("F26",), oracle=f"""
WITH {_EV_SQL},
{_bins_sql(LSH_BITS, LSH_SEED)},
cb AS (SELECT c.query_id AS label, sum(CASE WHEN list_sum(list_transform(range(1, len(p.p) + 1),
         lambda i: c.c[i] * p.p[i])) >= 0 THEN (1::BIGINT << ({LSH_BITS - 1} - p.j)) ELSE 0 END)::BIGINT AS cbin
       FROM cent c, planes_eb p GROUP BY c.query_id)
SELECT eb.vec_id, ({LSH_BITS} - bit_count(xor(eb.bin, cb.cbin)))::BIGINT AS agree
FROM eb JOIN ev USING (vec_id) JOIN cb ON ev.label = cb.label
""")
def lsh_bit_agreement(spark, sf_dir):
    """Number of signature bits each vector shares with its label mean's signature."""
    ev = scaled_embeddings(spark, sf_dir)
    planes = L.hyperplanes(LSH_BITS, 64, LSH_SEED)
    cent = label_centroids(ev).select(F.col("query_id").alias("label"),
                                      L.signature(F.col("c"), planes).alias("cbin"))
    eb = ev.withColumn("bin", L.signature("w", planes))
    return (eb.join(F.broadcast(cent), "label")
            .select("vec_id", (F.lit(LSH_BITS) - F.bit_count(F.col("bin").bitwiseXOR(F.col("cbin"))))
                    .cast("bigint").alias("agree")))


@query("lsh_query", rows=("F25", "N8", "N9"), oracle=f"""
WITH {_EV_SQL},
{_bins_sql(LSH_BITS, LSH_SEED)},
cb AS (SELECT vec_id AS query_id, bin AS qbin FROM eb WHERE vec_id % 50 = 0),
cand AS (SELECT cb.query_id, e.vec_id, {_COSINE_SQL} AS dist
         FROM cb JOIN eb ON bit_count(xor(cb.qbin, eb.bin)) <= {LSH_RADIUS}
         JOIN ev e ON e.vec_id = eb.vec_id JOIN qs c ON c.query_id = cb.query_id),
nc AS (SELECT query_id, count(*)::BIGINT AS n_candidates FROM cand GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), vec_id) AS rk FROM cand)
SELECT query_id, vec_id, rk::BIGINT AS rank, round(dist, 6) AS distance, n_candidates
FROM r JOIN nc USING (query_id) WHERE rk <= {K_DENSE}
""")
def lsh_query(spark, sf_dir):
    """LSH search (radius ≤ 2) of each query vector, exact cosine of the candidates, top 5."""
    blocks, queries = packed_units(scaled_embeddings(spark, sf_dir), LSH_BITS, LSH_SEED)
    top, n = PS.search(blocks, queries, [(0, (1 << LSH_BITS) - 1, LSH_RADIUS)], K_DENSE)
    return top.join(n, ["setting", "query_id"]).select("query_id", F.col("id").alias("vec_id"), "rank",
                                                       (F.round("distance", 6) + F.lit(0.0)).alias("distance"), "n_candidates")


@query("lsh_precision", rows=("U3", "N10", "N11"), oracle=f"""
WITH {_EV_SQL},
{_bins_sql(LSH_BITS, LSH_SEED)},
cb AS (SELECT vec_id AS query_id, bin AS qbin FROM eb WHERE vec_id % 50 = 0),
alld AS (SELECT c.query_id, e.vec_id, {_COSINE_SQL} AS dist, bit_count(xor(cb.qbin, eb.bin)) AS radius
         FROM ev e JOIN eb USING (vec_id), qs c JOIN cb USING (query_id)),
truth AS (SELECT query_id, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id
            ORDER BY round(dist, 9), vec_id) AS rk FROM alld) WHERE rk <= 25),
radii AS (SELECT r FROM range(0, 4) t(r)),
lshk AS (SELECT * FROM (SELECT radii.r, alld.*, row_number() OVER (PARTITION BY radii.r, query_id
            ORDER BY round(dist, 9), vec_id) AS rk FROM alld JOIN radii ON alld.radius <= radii.r) WHERE rk <= 10),
per AS (SELECT radii.r, c.query_id,
          (SELECT count(*) FROM alld WHERE alld.query_id = c.query_id AND alld.radius <= radii.r) AS n_cand,
          (SELECT count(*) FROM lshk JOIN truth USING (query_id, vec_id)
             WHERE lshk.r = radii.r AND lshk.query_id = c.query_id) AS hits,
          (SELECT avg(dist) FROM lshk WHERE lshk.r = radii.r AND lshk.query_id = c.query_id) AS md
        FROM radii, qs c)
SELECT r::BIGINT AS radius, round(avg(hits / 10.0), 6) AS precision,
       round(avg(n_cand), 6) AS avg_candidates, round(avg(md), 6) AS avg_distance
FROM per GROUP BY r
""")
def lsh_precision(spark, sf_dir):
    """Quality by search radius 0..3: precision of the LSH top 10 against the exact top 25,
    candidates examined, mean distance of the returned 10 — averaged over the queries. All radii
    and the exact search share one pass."""
    blocks, queries = packed_units(scaled_embeddings(spark, sf_dir), LSH_BITS, LSH_SEED)
    return _lsh_quality(blocks, queries, [(r, (1 << LSH_BITS) - 1, r) for r in range(4)]).withColumnRenamed("name", "radius")


def _lsh_quality(blocks, queries, settings):
    exact = len(settings)
    top, n = PS.search(blocks, queries, [*((s, mask, radius) for s, (_, mask, radius) in enumerate(settings)), (exact, 0, 0)], 25)
    top = written(top, "neighbours")
    truth = top.where(F.col("setting") == exact).select("query_id", "id", F.lit(1).alias("hit"))
    got = (top.where((F.col("setting") < exact) & (F.col("rank") <= 10)).join(truth, ["query_id", "id"], "left")
           .groupBy("setting", "query_id").agg(F.sum(F.coalesce("hit", F.lit(0))).alias("hits"), F.avg("distance").alias("md")))
    names = F.create_map(*[x for s, (name, _, _) in enumerate(settings) for x in (F.lit(s), F.lit(name).cast("bigint"))])
    return (got.join(n, ["setting", "query_id"]).groupBy("setting")       # a query is a candidate of its own
            .agg(F.round(F.avg(F.col("hits") / 10.0), 6).alias("precision"), F.round(F.avg(F.col("n_candidates").cast("double")), 6).alias("avg_candidates"),
                 F.round(F.avg("md"), 6).alias("avg_distance"))
            .select(names[F.col("setting")].alias("name"), "precision", "avg_candidates", "avg_distance"))


# ---------------------------------------------------------------- kNN regression (2-d, exact)

from pyspark.sql import Window  # noqa: E402

from tessera.functions.hashing import bucket, sql_hash32  # noqa: E402
from tessera.operators.knn_strata import knn_strata  # noqa: E402

KNN_MAX_K, KNN_K = 15, 5


def _knn_parts(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", F.col("p_size").cast("bigint").alias("p_size"), "p_retailprice",
        F.when(bucket("p_partkey", 51) < 800, "train").otherwise("valid").alias("split"))
    nr = p.where(F.col("split") == "train").agg(
        F.sqrt(F.sum(F.col("p_size") * F.col("p_size"))).alias("ns"),
        F.sqrt(F.sum(F.col("p_partkey").cast("double") * F.col("p_partkey"))).alias("nk")).collect()[0]
    ref = p.where(F.col("split") == "train").select(
        F.col("p_partkey").alias("rid"), F.col("p_size").alias("s"),
        F.col("p_partkey").cast("double").alias("t"), F.col("p_retailprice").alias("y"))
    q = p.where(F.col("split") == "valid").select(
        F.col("p_partkey").alias("qid"), F.col("p_size").alias("s"),
        F.col("p_partkey").cast("double").alias("t"), F.col("p_retailprice").alias("qy"))
    ns, nk = nr["ns"], nr["nk"]

    def dist(qs, qt, rs, rt):
        return F.sqrt(F.pow((qs - rs) / F.lit(ns), 2) + F.pow((qt - rt) / F.lit(nk), 2))
    def scaled(s, t):
        return F.array(F.col(s) / F.lit(ns), F.col(t) / F.lit(nk)).alias("vec")
    near = search(spread(ref.select(F.col("rid").alias("row"), F.lit(0).alias("label"), scaled("s", "t"))),
                  q.where("qid is not null").select(F.col("qid").alias("query_id"), scaled("s", "t")), KNN_MAX_K, places=12)
    # an id that comes several times counts so often in both joins, and only then are the nearest taken
    nn = (near.select(F.col("query_id").alias("qid"), F.col("row").alias("rid"), "distance")
          .join(ref.select("rid", "y"), "rid").join(q.select("qid"), "qid"))
    nn = NB.topk_per_group(nn, "qid", [F.round("distance", 12), F.col("rid")], KNN_MAX_K).select("qid", "rid", "y", "distance", "rank")
    unsized = q.where("s is null")
    if not unsized.isEmpty():           # no distance orders their neighbours
        nn = nn.unionByName(knn_strata(ref, unsized.select("qid", "s", "t"), KNN_MAX_K, dist, ["y"]).select(nn.columns))
    return nn.join(q.select("qid", "qy"), "qid")


_KNN_SQL = f"""
p AS (SELECT p_partkey, p_size, p_retailprice,
             CASE WHEN {sql_hash32('p_partkey', 51)} % 1000 < 800 THEN 'train' ELSE 'valid' END AS split FROM part),
nr AS (SELECT sqrt(sum(p_size * p_size)) AS ns, sqrt(sum(p_partkey::DOUBLE * p_partkey)) AS nk
       FROM p WHERE split = 'train'),
d AS (SELECT q.p_partkey AS qid, q.p_retailprice AS qy, r.p_retailprice AS y,
             sqrt(pow((q.p_size - r.p_size) / nr.ns, 2) + pow((q.p_partkey - r.p_partkey) / nr.nk, 2)) AS dist,
             row_number() OVER (PARTITION BY q.p_partkey ORDER BY round(sqrt(pow((q.p_size - r.p_size) / nr.ns, 2)
               + pow((q.p_partkey - r.p_partkey) / nr.nk, 2)), 12), r.p_partkey) AS rk
      FROM p q, p r, nr WHERE q.split = 'valid' AND r.split = 'train'),
nn AS (SELECT * FROM d WHERE rk <= {KNN_MAX_K})"""


@query("knn_regression", rows=("N5",), oracle=f"""
WITH {_KNN_SQL}
SELECT qid AS p_partkey, round(avg(y), 6) AS prediction FROM nn WHERE rk <= {KNN_K} GROUP BY qid
""")
def knn_regression(spark, sf_dir):
    """k-NN regression (k = 5) of p_retailprice on (p_size, p_partkey) normalised by the
    training norms, for every validation part; exact neighbours without a pair table."""
    nn = _knn_parts(spark, sf_dir)
    return (nn.where(F.col("rank") <= KNN_K).groupBy(F.col("qid").alias("p_partkey"))
            .agg(F.round(F.avg("y"), 6).alias("prediction")))


@query("knn_choose_k", rows=("N6",), oracle=f"""
WITH {_KNN_SQL},
pk AS (SELECT qid, rk AS k, qy, avg(y) OVER (PARTITION BY qid ORDER BY rk ROWS UNBOUNDED PRECEDING) AS pred
       FROM nn),
r AS (SELECT k, sum((qy - pred) ^ 2) AS rss FROM pk GROUP BY k)
SELECT k::BIGINT AS k, round(rss, 4) AS rss, k = (SELECT k FROM r ORDER BY rss, k LIMIT 1) AS best FROM r
""")
def knn_choose_k(spark, sf_dir):
    """Validation RSS for k = 1..15 from one ranked neighbour table (running mean per query),
    and the best k — one kNN search instead of fifteen."""
    nn = _knn_parts(spark, sf_dir)
    w = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    pk = nn.select("qid", F.col("rank").alias("k"), "qy", F.avg("y").over(w).alias("pred"))
    r = pk.groupBy("k").agg(F.sum(F.pow(F.col("qy") - F.col("pred"), 2)).alias("rss"))
    best = r.orderBy("rss", "k").limit(1).select(F.col("k").alias("bk"))
    return (r.join(F.broadcast(best), how="left", on=F.col("k") == F.col("bk"))
            .select(F.col("k").cast("bigint").alias("k"), F.round("rss", 4).alias("rss"),
                    F.col("bk").isNotNull().alias("best")))


# ---------------------------------------------------------------- LSH quality vs signature length

_SWEEP_BITS = list(range(5, SWEEP_BITS + 1))


@query("lsh_vectors_sweep", rows=("N12",), oracle=f"""
WITH {_EV_SQL},
{_bins_sql(SWEEP_BITS, SWEEP_SEED)},
cb AS (SELECT vec_id AS query_id, bin AS qbin FROM eb WHERE vec_id % 50 = 0),
alld AS (SELECT c.query_id, e.vec_id, {_COSINE_SQL} AS dist FROM ev e, qs c),
truth AS (SELECT query_id, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id
            ORDER BY round(dist, 9), vec_id) AS rk FROM alld) WHERE rk <= 25),
bs AS (SELECT unnest(range(5, {SWEEP_BITS + 1})) AS b),
cand AS (SELECT bs.b, cb.query_id, eb.vec_id, alld.dist FROM bs, cb
         JOIN eb ON true JOIN alld ON alld.query_id = cb.query_id AND alld.vec_id = eb.vec_id
         WHERE (eb.bin >> ({SWEEP_BITS} - bs.b)) = (cb.qbin >> ({SWEEP_BITS} - bs.b))),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, query_id ORDER BY round(dist, 9), vec_id)
        AS rk FROM cand) WHERE rk <= 10),
per AS (SELECT bs.b, c.query_id,
          (SELECT count(*) FROM cand WHERE cand.b = bs.b AND cand.query_id = c.query_id) AS n_cand,
          (SELECT count(*) FROM top JOIN truth USING (query_id, vec_id) WHERE top.b = bs.b
             AND top.query_id = c.query_id) AS hits,
          (SELECT avg(dist) FROM top WHERE top.b = bs.b AND top.query_id = c.query_id) AS md
        FROM bs, qs c)
SELECT b::BIGINT AS n_bits, round(avg(hits / 10.0), 6) AS precision, round(avg(n_cand), 6) AS avg_candidates,
       round(avg(md), 6) AS avg_distance FROM per GROUP BY b
""")
def lsh_vectors_sweep(spark, sf_dir):
    """LSH quality by number of hyperplanes (5..19), exact-bin candidates: precision of the top 10
    against the exact top 25, candidates, mean distance. One 19-bit signature serves every
    length (its leading bits), in one pass over the vectors."""
    blocks, queries = packed_units(scaled_embeddings(spark, sf_dir), SWEEP_BITS, SWEEP_SEED)
    settings = [(b, ((1 << b) - 1) << (SWEEP_BITS - b), 0) for b in _SWEEP_BITS]
    return _lsh_quality(blocks, queries, settings).withColumnRenamed("name", "n_bits")
