"""Sources, model tables, streams and function surfaces as queries.

Fixed values: events are replayed in eight batches, md5(event_id:77) % 8, as one file stream
with one step of size 0.5 per micro-batch; the fixed model of the scored stream is
(0.1, 0.2, -0.3); k-means tables hold k = 2, 3, 5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators import kmeans as KM
from tessera.plans.classification_queries import labelled_word_counts, word_log_odds
from tessera.plans.cluster_queries import K, LLOYD_ITERS, _assign_sql, _lloyd_sql, init_centroids, vectors
from tessera.registry import query
from tessera.session import scratch_path
from tessera.sources.tables import Tables, read_csv, read_model_table, write_model_table
from tessera.streaming.online import EVENT_SCHEMA, online_logistic, score_stream, versions

REPLAY, REPLAY_SALT, ONLINE_STEP = 8, 77, 0.5
FIXED_MODEL = [0.1, 0.2, -0.3]
FILE_ROWS = 1 << 20     # rows of a replayed file, about


@query("csv_table", rows=("S2",), oracle="""
SELECT p_brand, count(*)::BIGINT AS n, sum(p_size)::BIGINT AS size, round(sum(p_retailprice), 2) AS price,
       max(p_name) AS last_name FROM part GROUP BY p_brand
""")
def csv_table(spark, sf_dir):
    """The part table through a CSV file with header, read back with inferred types."""
    path = scratch_path(spark, "csv")
    Tables(spark, sf_dir).part.write.option("header", True).csv(path)
    p = read_csv(spark, path)
    return p.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("bigint").alias("size"),
                                    F.round(F.sum("p_retailprice"), 2).alias("price"), F.max("p_name").alias("last_name"))


_MODEL_SQL = """
WITH lb AS (SELECT doc_id, 2 * quality - 1 AS y FROM labels),
wc AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
        (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents
         WHERE doc_id IN (SELECT doc_id FROM lb)) WHERE w <> '' GROUP BY 1, 2),
lo AS (SELECT word, ln((coalesce(sum(cnt) FILTER (WHERE y = 1), 0) + 1)::DOUBLE
                       / (coalesce(sum(cnt) FILTER (WHERE y = -1), 0) + 1)) AS weight
       FROM wc JOIN lb USING (doc_id) GROUP BY word)
SELECT doc_id, round(sum(cnt * weight), 6) AS margin FROM wc JOIN lo USING (word) GROUP BY doc_id
"""


@query("model_reload", rows=("S5",), oracle=_MODEL_SQL)
def model_reload(spark, sf_dir):
    """Fit the log-odds word model, write it as a table, and score the labelled documents with what
    is read back."""
    wc, _ = labelled_word_counts(spark, sf_dir)
    path = scratch_path(spark, "word-model")
    write_model_table(word_log_odds(wc), path)
    model = read_model_table(spark, path)
    return (wc.join(model, "word").groupBy("doc_id").agg(F.round(F.sum(F.col("count") * F.col("weight")), 6).alias("margin")))


@query("kmeans_by_k", rows=("S6", "K9"), oracle=f"""
WITH {_lloyd_sql(LLOYD_ITERS)}, {_assign_sql(LLOYD_ITERS)}
SELECT k AS cluster, count(*)::BIGINT AS n, min(vec_id) AS first_id, max(vec_id) AS last_id FROM a{LLOYD_ITERS} GROUP BY k
""")
def kmeans_by_k(spark, sf_dir):
    """Centroids and assignments for several k, written partitioned by k; only the partition of
    k = 5 is read again."""
    ev = vectors(spark, sf_dir).persist()
    path = scratch_path(spark, "kmeans")
    assigned, centroids = None, []
    for k in (2, 3, K):
        cents, _ = KM.lloyd(ev, "v", init_centroids(ev, k), LLOYD_ITERS)
        a = KM.assign(ev, "v", cents).select(F.lit(k).alias("k"), "vec_id", "cluster")
        assigned = a if assigned is None else assigned.unionByName(a)
        centroids += [(k, i, [float(x) for x in c]) for i, c in enumerate(np.asarray(cents))]
    write_model_table(assigned, f"{path}/assignments", ["k"])
    write_model_table(spark.createDataFrame(centroids, "k int, cluster bigint, centroid array<double>"), f"{path}/centroids", ["k"])
    ev.unpersist()
    mine = read_model_table(spark, f"{path}/assignments").where(F.col("k") == K)
    named = read_model_table(spark, f"{path}/centroids").where(F.col("k") == K).select("cluster")
    return (mine.join(F.broadcast(named), "cluster").groupBy("cluster")       # k rows
            .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id")))


def _replayed(spark, sf_dir, name: str):
    """A file stream of the events whose micro-batches are the replayed batches, in order."""
    events = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    files = max(1, events.count() // (REPLAY * FILE_ROWS))
    path = scratch_path(spark, name)
    for b in range(REPLAY):        # one after the other: a file stream goes by the files' times
        events.where(bucket("event_id", REPLAY_SALT, REPLAY) == b).repartition(files, "event_id").write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(path)



@query("online_events", rows=("Z1",), oracle=f"""
WITH RECURSIVE e AS (SELECT {sql_hash32('event_id', REPLAY_SALT)} % {REPLAY} AS b, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS ind,
  1.0::DOUBLE AS x0, value / 100.0 AS x1, hour(ts) / 24.0 AS x2 FROM events),
it(b, w0, w1, w2) AS (
  SELECT -1::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT b + 1, w0 + {ONLINE_STEP} / n * g0, w1 + {ONLINE_STEP} / n * g1, w2 + {ONLINE_STEP} / n * g2
  FROM (SELECT it.b, w0, w1, w2, count(*) AS n, sum(err * x0) AS g0, sum(err * x1) AS g1, sum(err * x2) AS g2
        FROM (SELECT it.*, e.x0, e.x1, e.x2, e.ind - 1 / (1 + exp(-(w0 * e.x0 + w1 * e.x1 + w2 * e.x2))) AS err FROM it JOIN e ON e.b = it.b + 1) it
        GROUP BY it.b, w0, w1, w2))
SELECT b AS batch_id, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM it WHERE b >= 0
""")
def online_events(spark, sf_dir):
    """Online logistic regression over the replayed event stream, one step per micro-batch: the
    weights of every model version."""
    root = scratch_path(spark, "online")
    online_logistic(_replayed(spark, sf_dir, "events"), f"{root}/model", ONLINE_STEP, f"{root}/progress").awaitTermination()
    if not versions(spark, f"{root}/model"):
        return spark.createDataFrame([], "batch_id bigint, w0 double, w1 double, w2 double")
    m = spark.read.schema("index bigint, weight double, batch_id bigint").parquet(f"{root}/model")
    return m.groupBy("batch_id").agg(*[F.round(F.max(F.when(F.col("index") == i, F.col("weight"))), 6).alias(f"w{i}") for i in range(3)])


@query("scored_events", rows=("Z2",), oracle=f"""
WITH m AS (SELECT event_id, {FIXED_MODEL[0]} * 1.0 + {FIXED_MODEL[1]} * (value / 100.0) + {FIXED_MODEL[2]} * (hour(ts) / 24.0) AS m FROM events)
SELECT event_id, round(1 / (1 + exp(-m)), 6) AS probability, (CASE WHEN m > 0 THEN 1 ELSE -1 END)::BIGINT AS prediction FROM m
""")
def scored_events(spark, sf_dir):
    """Arriving events scored by a fixed model into a table."""
    root = scratch_path(spark, "scored")
    (score_stream(_replayed(spark, sf_dir, "events"), FIXED_MODEL).writeStream.format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start().awaitTermination())
    out = spark.read.schema("event_id bigint, margin double, probability double, prediction int").parquet(f"{root}/out")
    return out.select("event_id", F.round("probability", 6).alias("probability"), F.col("prediction").cast("bigint").alias("prediction"))


@query("function_surfaces", rows=("Q1", "Q2", "Q3", "Q4", "Q5"), oracle="""
WITH x AS (SELECT o_orderstatus, o_totalprice, length(o_orderpriority) AS n, CASE WHEN o_totalprice > 150000 AND o_orderstatus = 'O' THEN 1 ELSE 0 END AS big,
  ln(1 + o_totalprice) AS l, unnest(string_split(o_orderpriority, '-')) AS part FROM orders)
SELECT o_orderstatus, part, count(*)::BIGINT AS n, sum(n)::BIGINT AS letters, sum(big)::BIGINT AS big, round(avg(l), 6) AS mean_log, round(avg(o_totalprice), 4) AS mean_price
FROM x GROUP BY o_orderstatus, part
""")
def function_surfaces(spark, sf_dir):
    """A function of a column, one of a whole row, one over numpy arrays (all in Arrow batches), a
    generator of rows, and aggregates by name."""
    @F.pandas_udf("bigint")
    def letters(s: pd.Series) -> pd.Series:
        return s.str.len()

    @F.pandas_udf("bigint")
    def big(row: pd.DataFrame) -> pd.Series:
        return ((row["o_totalprice"] > 150000) & (row["o_orderstatus"] == "O")).astype("int64")

    @F.pandas_udf("double")
    def log1p(s: pd.Series) -> pd.Series:
        return pd.Series(np.log1p(s.to_numpy()))
    o = Tables(spark, sf_dir).orders
    x = o.select("o_orderstatus", "o_totalprice", letters("o_orderpriority").alias("letters"),
                 big(F.struct("o_totalprice", "o_orderstatus")).alias("big"), log1p("o_totalprice").alias("l"),
                 F.explode(F.split("o_orderpriority", "-")).alias("part"))
    a = x.withColumn("one", F.lit(1)).groupBy("o_orderstatus", "part").agg({"one": "count", "letters": "sum", "big": "sum", "l": "avg", "o_totalprice": "avg"})
    return a.select("o_orderstatus", "part", F.col("count(one)").alias("n"), F.col("sum(letters)").alias("letters"), F.col("sum(big)").alias("big"),
                    F.round("avg(l)", 6).alias("mean_log"), F.round("avg(o_totalprice)", 4).alias("mean_price"))
