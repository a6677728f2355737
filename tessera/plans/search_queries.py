"""Exact searches of a stated query set against all rows.

Fixtures (fixed values): query vectors: md5(vec_id:71) % 1000 < 20, the others are the training
vectors, classes: ``label``. Regression: parts with md5(p_partkey:72) % 1000 < 50 are queries,
the others train; features p_size, p_partkey, length(p_name), length(p_type), the brand's
number, each divided by its norm over the training parts; target p_retailprice.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators.block_search import search
from tessera.registry import query
from tessera.sources.tables import Tables, spread

MAX_K = 15


@query("nn_classify", rows=("N3", "J7"), oracle=f"""
WITH e AS (SELECT vec_id, label::BIGINT AS label, list_transform(embedding, lambda x: x::DOUBLE) AS v,
                  {sql_hash32('vec_id', 71)} % 1000 < 20 AS asked FROM embeddings),
d AS (SELECT q.vec_id, q.label AS truth, r.label, min(round(sqrt(list_sum(list_transform(range(1, len(q.v) + 1),
             lambda i: (q.v[i] - r.v[i]) ^ 2))), 9)) AS dist
      FROM e q, e r WHERE q.asked AND NOT r.asked GROUP BY ALL)
SELECT vec_id, any_value(truth) AS label, list(round(dist, 6) ORDER BY label) AS distances,
       arg_min(label, dist * 1e6 + label * 1e-6) AS prediction FROM (SELECT * FROM d ORDER BY label) GROUP BY vec_id
""")
def nn_classify(spark, sf_dir):
    """Nearest training vector of each class for every query vector (the classes' distances side
    by side, in label order), and the class of the nearest one."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", F.col("label").cast("bigint").alias("label"),
                                                V.to_double("embedding").alias("vec"))
    asked = bucket("vec_id", 71) < 20
    queries = e.where(asked)
    near = search(e.where(~asked).withColumnRenamed("vec_id", "row"), queries.withColumnRenamed("vec_id", "query_id"),
                  1, by_class=True)
    per = near.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("label", "distance"))), lambda s: F.round(s["distance"], 6)).alias("distances"),
        F.min(F.struct("distance", "label"))["label"].alias("prediction"))
    return queries.select("vec_id", "label").join(per, F.col("vec_id") == F.col("query_id")).select(
        "vec_id", "label", "distances", "prediction")


FEATURES = ["p_size", "p_partkey", "name_len", "type_len", "brand"]
_SQL = f"""
p AS (SELECT p_partkey AS id, p_retailprice AS y, p_size::DOUBLE AS f1, p_partkey::DOUBLE AS f2, length(p_name)::DOUBLE AS f3,
             length(p_type)::DOUBLE AS f4, regexp_extract(p_brand, '[0-9]+')::DOUBLE AS f5,
             {sql_hash32('p_partkey', 72)} % 1000 < 50 AS asked FROM part),
n AS (SELECT sqrt(sum(f1 * f1)) AS n1, sqrt(sum(f2 * f2)) AS n2, sqrt(sum(f3 * f3)) AS n3, sqrt(sum(f4 * f4)) AS n4,
             sqrt(sum(f5 * f5)) AS n5 FROM p WHERE NOT asked),
d AS (SELECT q.id AS qid, q.y AS qy, r.id, r.y, round(sqrt({' + '.join(f'((q.f{i} - r.f{i}) / n{i}) ^ 2' for i in range(1, 6))}), 9) AS dist
      FROM p q, p r, n WHERE q.asked AND NOT r.asked),
nn AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rk FROM d QUALIFY rk <= {MAX_K})"""


def _neighbours(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("y"), (bucket("p_partkey", 72) < 50).alias("asked"),
        F.array(F.col("p_size").cast("double"), F.col("p_partkey").cast("double"), F.length("p_name").cast("double"),
                F.length("p_type").cast("double"), F.regexp_extract("p_brand", "[0-9]+", 0).cast("double")).alias("f"))
    train = p.where(~F.col("asked"))
    norms = train.agg(*[F.sqrt(F.sum(F.col("f")[i] * F.col("f")[i])).alias(str(i)) for i in range(len(FEATURES))]).first()
    scaled = F.transform("f", lambda x, i: x / F.array(*[F.lit(float(v)) for v in norms])[i])
    queries = p.where("asked")
    near = search(spread(train.select(F.col("id").alias("row"), F.lit(0).alias("label"), scaled.alias("vec"))),
                  queries.select(F.col("id").alias("query_id"), scaled.alias("vec")), MAX_K)
    return (near.join(train.select(F.col("id").alias("row"), "y"), "row")
            .join(queries.select(F.col("id").alias("query_id"), F.col("y").alias("qy")), "query_id"))


@query("knn_regression_multi", rows=("N5",), oracle=f"""
WITH {_SQL}
SELECT qid AS p_partkey, round(avg(y) FILTER (rk <= 5), 6) AS prediction, round(avg(y), 6) AS prediction_15 FROM nn GROUP BY qid
""")
def knn_regression_multi(spark, sf_dir):
    """k-NN regression (k = 5 and 15) on five features normalised by their training norms."""
    nn = _neighbours(spark, sf_dir)
    return nn.groupBy(F.col("query_id").alias("p_partkey")).agg(
        F.round(F.avg(F.when(F.col("rank") <= 5, F.col("y"))), 6).alias("prediction"),
        F.round(F.avg("y"), 6).alias("prediction_15"))


@query("knn_choose_k_multi", rows=("N6",), oracle=f"""
WITH {_SQL},
pk AS (SELECT rk AS k, qy, avg(y) OVER (PARTITION BY qid ORDER BY rk ROWS UNBOUNDED PRECEDING) AS pred FROM nn)
SELECT k::BIGINT AS k, round(sum((qy - pred) ^ 2), 4) AS rss FROM pk GROUP BY k
""")
def knn_choose_k_multi(spark, sf_dir):
    """Validation RSS for k = 1 .. 15 from one search over five features."""
    nn = _neighbours(spark, sf_dir)
    w = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    pk = nn.select(F.col("rank").alias("k"), "qy", F.avg("y").over(w).alias("pred"))
    return pk.groupBy("k").agg(F.round(F.sum(F.pow(F.col("qy") - F.col("pred"), 2)), 4).alias("rss"))
