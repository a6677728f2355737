"""Recommendation queries.

Fixtures (fixed values): interactions = distinct (customer = o_custkey, part = l_partkey) of
lineitem ⋈ orders. Served and evaluated users: a seeded 5 % of the customers (md5(customer:41)
% 1000 < 50), the share on which the recommenders are compared; it grows with the table. Query
items for the similarity table: a seeded 5 % of the parts (md5(part:42) % 1000 < 50). Evaluation split of interactions: md5(customer:part:43) % 1000
< 800 → train.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators import recommend as RC
from tessera.operators.neighbors import topk_per_group
from tessera.registry import query
from tessera.sources.tables import Tables

U, I = "customer", "part"
SAMPLE_SEED, ITEM_SEED, SHARE = 41, 42, 50      # of 1000


def interactions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("o_custkey").alias(U), F.col("l_partkey").alias(I)).distinct()


def user_sample(inter):
    return inter.select(U).distinct().where(bucket(U, SAMPLE_SEED) < SHARE)


INTER_SQL = ("inter AS (SELECT DISTINCT o_custkey AS customer, l_partkey AS part FROM lineitem "
             "JOIN orders ON l_orderkey = o_orderkey)")


SAMPLE_SQL = f"S AS (SELECT DISTINCT customer FROM inter WHERE {sql_hash32('customer', SAMPLE_SEED)} % 1000 < {SHARE})"


def _itemsim_sql(inter: str, users: str, k: int, p: str = "") -> str:
    return f"""{p}hist AS (SELECT i.* FROM {inter} i JOIN {users} USING (customer)),
{p}deg AS (SELECT part, count(*) AS deg FROM {inter} GROUP BY part),
{p}qi AS (SELECT DISTINCT part AS qpart FROM {p}hist),
{p}co AS (SELECT qi.qpart, b.part, count(*) AS co FROM {p}qi qi JOIN {inter} a ON a.part = qi.qpart
          JOIN {inter} b ON a.customer = b.customer GROUP BY qi.qpart, b.part),
{p}sim AS (SELECT co.qpart, co.part, co.co / (dq.deg + d.deg - co.co) AS sim FROM {p}co co
           JOIN {p}deg dq ON dq.part = co.qpart JOIN {p}deg d ON d.part = co.part),
{p}nh AS (SELECT customer, count(*) AS n FROM {p}hist GROUP BY customer),
{p}sc AS (SELECT h.customer, s.part, sum(s.sim) / any_value(nh.n) AS score FROM {p}hist h
          JOIN {p}sim s ON s.qpart = h.part JOIN {p}nh nh ON nh.customer = h.customer GROUP BY h.customer, s.part),
{p}rec AS (SELECT customer, part, rk AS rank, score FROM (
           SELECT *, row_number() OVER (PARTITION BY customer ORDER BY round(score, 9) DESC, part) AS rk
           FROM {p}sc sc WHERE NOT EXISTS (SELECT 1 FROM {p}hist h WHERE h.customer = sc.customer
                                           AND h.part = sc.part)) WHERE rk <= {k})"""


def _pop_sql(inter: str, users: str, k: int, p: str = "") -> str:
    return f"""{p}pop AS (SELECT part, count(*) AS n_users, row_number() OVER (ORDER BY count(*) DESC, part) AS pop_rank
          FROM {inter} GROUP BY part),
{p}hn AS (SELECT u.customer, count(i.part) AS h FROM {users} u LEFT JOIN {inter} i USING (customer) GROUP BY u.customer),
{p}rec AS (SELECT customer, part, rk AS rank, n_users FROM (
           SELECT hn.customer, pop.part, pop.n_users,
                  row_number() OVER (PARTITION BY hn.customer ORDER BY pop.pop_rank) AS rk
           FROM {p}hn hn, {p}pop pop WHERE pop.pop_rank <= {k} + hn.h AND NOT EXISTS (
             SELECT 1 FROM {inter} i WHERE i.customer = hn.customer AND i.part = pop.part)) WHERE rk <= {k})"""


@query("popularity_recommend", rows=("D1",), oracle=f"""
WITH {INTER_SQL},
users AS (SELECT DISTINCT customer FROM inter),
{_pop_sql('inter', 'users', 5)}
SELECT customer, part, rank::BIGINT AS rank, n_users::BIGINT AS n_users FROM rec
""")
def popularity_recommend(spark, sf_dir):
    """Five most popular parts (by distinct customers) each customer has not bought, for every
    customer."""
    inter = interactions(spark, sf_dir)
    users = inter.select(U).distinct()
    return RC.popularity_recommend(inter, users, 5, U, I)


_ITEMS_SQL = f"asked AS (SELECT DISTINCT part AS qpart FROM inter WHERE {sql_hash32('part', ITEM_SEED)} % 1000 < {SHARE})"


def _asked(inter):
    return inter.select(I).distinct().where(bucket(I, ITEM_SEED) < SHARE)


@query("item_similarity", rows=("D2",), oracle=f"""
WITH {INTER_SQL}, {_ITEMS_SQL},
deg AS (SELECT part, count(*) AS deg FROM inter GROUP BY part),
co AS (SELECT p.qpart, b.part, count(*) AS co FROM asked p JOIN inter a ON a.part = p.qpart
       JOIN inter b ON a.customer = b.customer GROUP BY p.qpart, b.part)
SELECT co.qpart AS qitem, co.part, co.co::BIGINT AS co, round(co.co / (dq.deg + d.deg - co.co), 6) AS sim
FROM co JOIN deg dq ON dq.part = co.qpart JOIN deg d ON d.part = co.part WHERE co.part <> co.qpart
""")
def item_similarity(spark, sf_dir):
    """Jaccard similarity (customer sets) between 5 % of the parts and every part bought together
    with them."""
    inter = interactions(spark, sf_dir)
    s = RC.jaccard_for(inter, _asked(inter), U, I)
    return s.where(F.col("qitem") != F.col(I)).select(
        "qitem", I, F.col("co").cast("bigint").alias("co"), F.round("sim", 6).alias("sim"))


@query("similar_items", rows=("D4",), oracle=f"""
WITH {INTER_SQL}, {_ITEMS_SQL},
deg AS (SELECT part, count(*) AS deg FROM inter GROUP BY part),
co AS (SELECT p.qpart, b.part, count(*) AS co FROM asked p JOIN inter a ON a.part = p.qpart
       JOIN inter b ON a.customer = b.customer GROUP BY p.qpart, b.part),
s AS (SELECT co.qpart, co.part, co.co / (dq.deg + d.deg - co.co) AS sim FROM co JOIN deg dq ON dq.part = co.qpart
      JOIN deg d ON d.part = co.part WHERE co.part <> co.qpart)
SELECT qpart AS qitem, part, rk::BIGINT AS rank, round(sim, 6) AS sim FROM (
  SELECT *, row_number() OVER (PARTITION BY qpart ORDER BY round(sim, 9) DESC, part) AS rk FROM s) WHERE rk <= 5
""")
def similar_items(spark, sf_dir):
    """Five most similar parts of each of 5 % of the parts."""
    inter = interactions(spark, sf_dir)
    s = RC.jaccard_for(inter, _asked(inter), U, I).where(F.col("qitem") != F.col(I))
    top = topk_per_group(s, "qitem", [F.desc(F.round("sim", 9)), F.col(I)], 5)
    return top.select("qitem", I, "rank", F.round("sim", 6).alias("sim"))


_ALL_SQL = f"""
WITH {INTER_SQL},
deg AS (SELECT part, count(*) AS deg FROM inter GROUP BY part),
co AS (SELECT a.part AS qpart, b.part, count(*) AS co FROM inter a JOIN inter b ON a.customer = b.customer
       WHERE a.part <> b.part GROUP BY a.part, b.part),
s AS (SELECT co.qpart, co.part, co.co, co.co / (dq.deg + d.deg - co.co) AS sim FROM co JOIN deg dq ON dq.part = co.qpart
      JOIN deg d ON d.part = co.part)"""


@query("item_similarity_all", rows=("D2",), oracle=f"""{_ALL_SQL}
SELECT qpart AS qitem, part, co::BIGINT AS co, round(sim, 6) AS sim FROM s
""")
def item_similarity_all(spark, sf_dir):
    """Jaccard similarity (customer sets) of all pairs of parts bought by one customer."""
    s = RC.jaccard_all(interactions(spark, sf_dir), U, I)
    return s.select("qitem", I, F.col("co").cast("bigint").alias("co"), F.round("sim", 6).alias("sim"))


@query("similar_items_all", rows=("D4",), oracle=f"""{_ALL_SQL}
SELECT qpart AS qitem, part, rk::BIGINT AS rank, round(sim, 6) AS sim FROM (
  SELECT *, row_number() OVER (PARTITION BY qpart ORDER BY round(sim, 9) DESC, part) AS rk FROM s) WHERE rk <= 5
""")
def similar_items_all(spark, sf_dir):
    """Five most similar parts of every part."""
    s = RC.jaccard_all(interactions(spark, sf_dir), U, I, 5)
    top = topk_per_group(s, "qitem", [F.desc(F.round("sim", 9)), F.col(I)], 5)
    return top.select("qitem", I, "rank", F.round("sim", 6).alias("sim"))


@query("item_recommend", rows=("D3",), oracle=f"""
WITH {INTER_SQL}, {SAMPLE_SQL},
{_itemsim_sql('inter', 'S', 5)}
SELECT customer, part, rank::BIGINT AS rank, round(score, 6) AS score FROM rec
""")
def item_recommend(spark, sf_dir):
    """Item-similarity recommendations (mean Jaccard to the customer's parts), top 5, for a
    seeded 5 % of the customers."""
    inter = interactions(spark, sf_dir)
    r = RC.item_similarity_recommend(inter, user_sample(inter), 5, U, I)
    return r.select(U, I, "rank", F.round("score", 6).alias("score"))


@query("item_recommend_all", rows=("D3",), oracle=f"""
WITH {INTER_SQL}, everyone AS (SELECT DISTINCT customer FROM inter),
{_itemsim_sql('inter', 'everyone', 5)}
SELECT customer, part, rank::BIGINT AS rank, round(score, 6) AS score FROM rec
""")
def item_recommend_all(spark, sf_dir):
    """Item-similarity recommendations, top 5, for every customer."""
    r = RC.item_recommend_all(interactions(spark, sf_dir), 5, U, I)
    return r.select(U, I, "rank", F.round("score", 6).alias("score"))


@query("top1_item_counts", rows=("A3", "D5"), oracle=f"""
WITH {INTER_SQL}, {SAMPLE_SQL},
{_itemsim_sql('inter', 'S', 1)}
SELECT part, count(*)::BIGINT AS n_users FROM rec GROUP BY part
""")
def top1_item_counts(spark, sf_dir):
    """How often each part is the top recommendation over a seeded 5 % of the customers."""
    inter = interactions(spark, sf_dir)
    r = RC.item_similarity_recommend(inter, user_sample(inter), 1, U, I)
    return r.groupBy(I).agg(F.count(F.lit(1)).alias("n_users"))


CUTOFFS = list(range(1, 11))


def _pr_sql():
    return f"""
WITH {INTER_SQL}, {SAMPLE_SQL},
tr AS (SELECT * FROM inter WHERE {sql_hash32("concat_ws(':', customer, part)", 43)} % 1000 < 800),
te AS (SELECT * FROM inter WHERE {sql_hash32("concat_ws(':', customer, part)", 43)} % 1000 >= 800),
{_pop_sql('tr', 'S', 10, 'p_')},
{_itemsim_sql('tr', 'S', 10, 'i_')},
recs AS (SELECT 'popularity' AS model, customer, part, rank FROM p_rec
         UNION ALL SELECT 'item_similarity', customer, part, rank FROM i_rec),
nt AS (SELECT customer, count(*) AS n_test FROM te JOIN S USING (customer) GROUP BY customer),
c AS (SELECT unnest(range(1, 11)) AS cutoff),
m AS (SELECT DISTINCT model FROM recs),
per AS (SELECT m.model, nt.customer, c.cutoff, nt.n_test,
               (SELECT count(*) FROM recs r JOIN te ON te.customer = r.customer AND te.part = r.part
                WHERE r.model = m.model AND r.customer = nt.customer AND r.rank <= c.cutoff) AS hits
        FROM m, nt, c)
SELECT model, cutoff::BIGINT AS cutoff, round(avg(hits / cutoff), 6) AS precision,
       round(avg(hits / n_test), 6) AS recall FROM per GROUP BY model, cutoff
"""


@query("recommender_pr", rows=("D6",), oracle=_pr_sql())
def recommender_pr(spark, sf_dir):
    """Precision and recall at cutoffs 1..10 of both recommenders trained on 80 % of the
    interactions, averaged over sampled customers that have held-out parts."""
    inter = interactions(spark, sf_dir)
    key = F.concat_ws(":", F.col(U).cast("string"), F.col(I).cast("string"))
    tr = inter.where(bucket(key, 43) < 800)
    te = inter.where(bucket(key, 43) >= 800)
    users = user_sample(inter)
    recs = (RC.popularity_recommend(tr, users, 10, U, I).select(F.lit("popularity").alias("model"), U, I, "rank")
            .unionByName(RC.item_similarity_recommend(tr, users, 10, U, I)
                         .select(F.lit("item_similarity").alias("model"), U, I, "rank")))
    nt = te.join(users, U, "left_semi").groupBy(U).agg(F.count(F.lit(1)).alias("n_test"))
    hits = recs.join(te.withColumn("hit", F.lit(1)), [U, I], "left").na.fill({"hit": 0})
    cut = F.explode(F.array(*[F.lit(c) for c in CUTOFFS])).alias("cutoff")
    per = (hits.select("model", U, "rank", "hit", cut)
           .groupBy("model", U, "cutoff")
           .agg(F.sum(F.when(F.col("rank") <= F.col("cutoff"), F.col("hit")).otherwise(0)).alias("hits")))
    full = (nt.select(U, "n_test", F.explode(F.array(F.lit("popularity"), F.lit("item_similarity")))
                      .alias("model"))
            .select("*", cut))
    j = full.join(per, ["model", U, "cutoff"], "left").na.fill({"hits": 0})
    return j.groupBy("model", F.col("cutoff").cast("bigint").alias("cutoff")).agg(
        F.round(F.avg(F.col("hits") / F.col("cutoff")), 6).alias("precision"),
        F.round(F.avg(F.col("hits") / F.col("n_test")), 6).alias("recall"))
