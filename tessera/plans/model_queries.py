"""Packaged-model and sweep queries checked by rows and invariants, not by SQL
(SURVEY 7.2b "rows only"): MLlib estimators whose inference differs from any SQL
formulation (LBFGS/OWLQN, GBT, LDA, k-means||), and searches that loop over fits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, hash32
from tessera.functions.text import WHITESPACE, tokens
from tessera.operators import gibbs_lda as LDA
from tessera.operators import gram as G
from tessera.operators import heavy_hitters as HH
from tessera.operators import kmeans as KM
from tessera.operators import minibatch as MB
from tessera.operators import packed_gmm as PG
from tessera.operators import sparse_rows as SR
from tessera.operators.neighbors import topk_per_group
from tessera.plans.classification_queries import MINI_STEPS, dense_features, minibatch_sql, rowkey, scored
from tessera.plans.cluster_queries import colours, gmm_start, init_centroids, vectors
from tessera.plans.fixtures import STOP_WORDS
from tessera.plans.regression_queries import LI_FEATURES, _normalised_system, li_frame
from tessera.plans.tree_queries import FEATURES as TREE_FEATURES
from tessera.plans.tree_queries import tree_frame
from tessera.registry import query
from tessera.session import cut_lineage, forget
from tessera.sources.tables import Tables, spread


#: No cap on the vocabulary (the estimator asks for a number).
WHOLE = 2**31 - 1


SKETCHED, COUNTERS, SHOWN = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 100, 3
FREQUENT_COLUMNS = ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_linenumber"]


@query("sketch_summary", rows=("A6",))
def sketch_summary(spark, sf_dir):
    """Sketch summary of the numeric lineitem columns: count, mean, stddev, min, approximate
    quartiles, max, approximate distinct count (HyperLogLog++) and the most frequent items with
    the bounds of their counts (Misra-Gries, 100 counters), in three scans."""
    li = Tables(spark, sf_dir).lineitem.select(*SKETCHED)
    s = li.summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
    d = li.agg(*[F.approx_count_distinct(c).cast("string").alias(c) for c in SKETCHED]) \
        .select(F.lit("approx_distinct").alias("summary"), *SKETCHED)
    items = topk_per_group(HH.frequent_items(li, COUNTERS), "col", [F.desc("upper"), F.col("item")], SHOWN)
    shown = F.concat(F.col("item"), F.lit(" ("), F.col("lower"), F.lit(".."), F.col("upper"), F.lit(")"))
    f = items.groupBy("rank").pivot("col", SKETCHED).agg(F.first(shown)) \
        .select(F.concat(F.lit("frequent_"), F.col("rank")).alias("summary"), *SKETCHED)
    return s.unionByName(d).unionByName(f)


def _frequent_sql(columns) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col, {c}::VARCHAR AS item, count(*)::BIGINT AS n, true AS within FROM lineitem GROUP BY {c} "
        f"HAVING count(*) * {COUNTERS + 1} > (SELECT count({c}) FROM lineitem)" for c in columns)


@query("frequent_items", rows=("A6",), oracle=_frequent_sql(FREQUENT_COLUMNS))
def frequent_items(spark, sf_dir):
    """Items that hold more than 1/101 of a column's values: all of them have one of the 100
    counters; a second scan counts the candidates, and checks each against its bounds."""
    columns = FREQUENT_COLUMNS
    li = Tables(spark, sf_dir).lineitem.select(*columns)
    found = HH.frequent_items(li, COUNTERS)
    values = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("item")) for c in columns])).alias("x")).select("x.*")
    exact = values.join(F.broadcast(found.select("col", "item")), ["col", "item"], "left_semi").groupBy("col", "item").agg(F.count(F.lit(1)).alias("n"))
    within = (F.col("lower") <= F.col("n")) & (F.col("n") <= F.col("upper"))        # 100 candidates a column
    return (exact.join(F.broadcast(found), ["col", "item"]).where(F.col("n") * (COUNTERS + 1) > F.col("total"))
            .select("col", "item", "n", within.alias("within")))


@query("frequent_words", rows=("A6",), oracle=f"""
WITH w AS (SELECT unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS item FROM documents),
v AS (SELECT item FROM w WHERE item <> '')
SELECT item, count(*)::BIGINT AS n, true AS within FROM v GROUP BY item HAVING count(*) * {1001} > (SELECT count(*) FROM v)
""")
def frequent_words(spark, sf_dir):
    """Words that make up more than 1/1001 of all words, from 1000 counters and a second scan."""
    docs = spread(Tables(spark, sf_dir).documents.select("text"))
    words = docs.select(F.explode(F.split(F.lower("text"), WHITESPACE)).alias("item")).where("item <> ''")
    found = HH.frequent_items(words, 1000)
    exact = words.join(F.broadcast(found.select("item")), "item", "left_semi").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    within = (F.col("lower") <= F.col("n")) & (F.col("n") <= F.col("upper"))
    return exact.join(F.broadcast(found), "item").where(F.col("n") * 1001 > F.col("total")).select("item", "n", within.alias("within"))


@query("lasso_sparsity", rows=("R24",))
def lasso_sparsity(spark, sf_dir):
    """Penalty giving exactly 2 nonzero weights: bracket on a coarse log grid, then a fine grid
    inside the bracket keeping the lowest validation RSS among fits with that sparsity
    (the reference's fine search skips the sparsity check; we keep it)."""
    target = 2
    li = li_frame(spark, sf_dir)
    feats = {f: F.col(f) for f in LI_FEATURES}
    grams = G.gram(li, feats, "y", by=["split"])
    gtr, gte = grams[("train",)], grams[("test",)]
    Gn, bn, norms, _ = _normalised_system(gtr)
    Gt, bt, yyt = gte.raw_system()

    def fit(l1):
        w, _ = G.lasso_coordinate_descent(Gn, bn, np.zeros(len(bn)), l1, 1.0)
        w = w / norms
        return w, int(np.sum(w[1:] != 0)), float(yyt - 2 * w @ bt + w @ Gt @ w)

    coarse = [10.0 ** e for e in np.arange(1, 8, 0.5)]
    fits = [(l1, *fit(l1)) for l1 in coarse]
    l1_min = max((l1 for l1, _, nnz, _ in fits if nnz > target), default=coarse[0])
    l1_max = min((l1 for l1, _, nnz, _ in fits if nnz < target), default=coarse[-1])
    fine = [(float(l1), *fit(float(l1))) for l1 in np.linspace(l1_min, l1_max, 20)]
    ok = [(rss, l1) for l1, _, nnz, rss in fine if nnz == target]
    best = min(ok)[1] if ok else None
    rows = [(float(l1), int(nnz), round(rss, 2), "coarse", False) for l1, _, nnz, rss in fits]
    rows += [(float(l1), nnz, round(rss, 2), "fine", bool(best is not None and l1 == best))
             for l1, _, nnz, rss in fine]
    return spark.createDataFrame(rows, "l1 double, nnz bigint, val_rss double, phase string, best boolean")


def _labelled_docs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return spread(t.documents.select("doc_id", "text")).join(t.labels, "doc_id").select(
        "doc_id", tokens("text").alias("words"), F.col("quality").cast("double").alias("label"),
        F.when(bucket("doc_id", 1) < 800, "train").otherwise("test").alias("split"))


@query("logistic_mllib", rows=("C1", "C3"))
def logistic_mllib(spark, sf_dir):
    """Logistic regression on sparse word counts (CountVectorizer → MLlib LBFGS); coefficient
    signs and accuracy by split. L2 penalty λ maps to regParam = 2λ/n (SURVEY §4)."""
    d = _labelled_docs(spark, sf_dir).persist()
    cv = CountVectorizer(inputCol="words", outputCol="features", minDF=1.0, vocabSize=WHOLE).fit(d.where(F.col("split") == "train"))
    x = cv.transform(d)
    train = x.where(F.col("split") == "train")
    n = train.count()
    model = LogisticRegression(regParam=2 * 1.0 / max(n, 1), maxIter=50, standardization=False).fit(train)
    coef = model.coefficients.toArray()
    acc = (model.transform(x).groupBy("split")
           .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
           .collect())
    d.unpersist()
    rows = [(r["split"], float(r["accuracy"]), int((coef > 0).sum()), int((coef < 0).sum()),
             len(cv.vocabulary)) for r in acc]
    return spark.createDataFrame(rows, "split string, accuracy double, n_positive bigint, "
                                       "n_negative bigint, vocabulary bigint")


@query("logistic_multiclass", rows=("C2",))
def logistic_multiclass(spark, sf_dir):
    """Multinomial logistic regression on the embedding vectors (10 labels): accuracy by split."""
    e = Tables(spark, sf_dir).embeddings.select(
        "vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
        F.col("label").cast("double").alias("label"),
        F.when(bucket("vec_id", 1) < 800, "train").otherwise("test").alias("split"))
    model = LogisticRegression(family="multinomial", maxIter=50).fit(e.where(F.col("split") == "train"))
    return (model.transform(e).groupBy("split")
            .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n")))


@query("sgd_stepsize", rows=("C17",), oracle=minibatch_sql(
    1, 10, 5, MINI_STEPS, "size AS step_size, k::BIGINT AS batch, round(ll, 5) AS avg_loglik"))
def sgd_stepsize(spark, sf_dir):
    """Mini-batch gradient ascent over a step-size grid: average log likelihood of every batch
    (one epoch of 10 batches per step size; all step sizes advance in the same batch pass)."""
    s = scored(spark, sf_dir)
    x = F.array(*[f.cast("double") for f in dense_features()])
    rows = s.select(rowkey(s).alias("rk"), x.alias("x"), F.when(F.col("label") == 1, 1.0).otherwise(0.0).alias("ind"))
    table = MB.batch_table(rows, [F.col("rk"), F.col("x")[1], F.col("x")[2], F.col("ind")], [5], lambda salt: hash32("rk", salt), 10)
    out = MB.ascend(table, 3, 10, MINI_STEPS)
    forget(table)
    return spark.createDataFrame([(size, k, round(float(v), 5)) for k, ll, _ in out for size, v in zip(MINI_STEPS, ll)],
                                 "step_size double, batch bigint, avg_loglik double")


def _tree_vectors(spark, sf_dir):
    d = tree_frame(spark, sf_dir)
    va = VectorAssembler(inputCols=TREE_FEATURES, outputCol="features")
    return va.transform(d).select("features", ((F.col("y") + 1) / 2).alias("label"), "split")


@query("tree_mllib", rows=("C19",))
def tree_mllib(spark, sf_dir):
    """MLlib decision trees (Gini) of depth 2, 6 and 10: accuracy by split."""
    d = _tree_vectors(spark, sf_dir).persist()
    train = d.where(F.col("split") == "train")
    out = []
    for depth in (2, 6, 10):
        m = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(train)
        for r in (m.transform(d).groupBy("split")
                  .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).collect()):
            out.append((depth, r["split"], float(r["a"]), m.numNodes))
    d.unpersist()
    return spark.createDataFrame(out, "max_depth bigint, split string, accuracy double, n_nodes bigint")


@query("kmeans_seeds", rows=("K6", "K8"))
def kmeans_seeds(spark, sf_dir):
    """Lloyd k-means (k = 5, until no row changes) from seven hash-chosen starts: final
    heterogeneity, largest cluster, and the best run."""
    ev = vectors(spark, sf_dir).persist()
    runs = KM.lloyd_runs(ev, "v", {seed: init_centroids(ev, seed=seed) for seed in range(21, 28)}, 400)
    rows = []
    for seed, (cents, trace) in sorted(runs.items()):
        sizes = KM.assign(ev, "v", cents).groupBy("cluster").count().collect()
        rows.append((seed, float(trace[-1][1]), max(r["count"] for r in sizes), len(trace)))
    ev.unpersist()
    best = min(rows, key=lambda r: r[1])[0]
    return spark.createDataFrame([r + (r[0] == best,) for r in rows],
                                 "seed bigint, heterogeneity double, largest_cluster bigint, "
                                 "iterations bigint, best boolean")


@query("kmeans_elbow", rows=("K9",))
def kmeans_elbow(spark, sf_dir):
    """Heterogeneity by k (MLlib k-means with k-means|| initialisation)."""
    ev = vectors(spark, sf_dir).select(array_to_vector("v").alias("features")).persist()
    rows = []
    for k in (2, 10, 25, 50, 100):
        m = KMeans(k=k, seed=1, maxIter=20).fit(ev)
        rows.append((k, float(m.summary.trainingCost)))
    ev.unpersist()
    return spark.createDataFrame(rows, "k bigint, heterogeneity double")


@query("bisect_clusters", rows=("K11",))
def bisect_clusters(spark, sf_dir):
    """Hierarchical (bisecting) k-means to 4 leaves: cluster sizes."""
    ev = vectors(spark, sf_dir).select("vec_id", array_to_vector("v").alias("features"))
    m = BisectingKMeans(k=4, seed=1, maxIter=20).fit(ev)
    return m.transform(ev).groupBy(F.col("prediction").cast("bigint").alias("cluster")) \
        .agg(F.count(F.lit(1)).alias("n"))


EM_GAIN, EM_MAX = 1e-4, 1000


@query("gmm_fit", rows=("K15", "K16"))
def gmm_fit(spark, sf_dir):
    """EM on the colour triples until the log likelihood gains less than 1e-4 (at most 1000 steps): log
    likelihood before every step; must not fall. Equal triples are one weighted row."""
    c = colours(spark, sf_dir)
    rows = c.groupBy("r", "g", "b").agg(F.count(F.lit(1)).alias("n")).select(
        F.monotonically_increasing_id().alias("id"), F.array(F.lit(0), F.lit(1), F.lit(2)).alias("cols"),
        F.array("r", "g", "b").alias("vals"), F.col("n").cast("double").alias("extra"))
    *_, trace = PG.em_full(SR.summary_block(rows), *gmm_start(c), EM_GAIN, EM_MAX)
    return spark.createDataFrame(list(enumerate(trace)), "iteration bigint, loglik double")


TOPICS, SWEEPS, LOCAL_SWEEPS, DRAWS, BURN, LDA_SEED = 10, 200, 10, 100, 5, 1
_PRIOR = LDA.Setting("default", 50 / TOPICS, 0.1)
LDA_SETTINGS = [_PRIOR, LDA.Setting("low_alpha", 1.0, 0.1), LDA.Setting("high_alpha", 50.0, 0.1),
                LDA.Setting("low_beta", 50 / TOPICS, 0.02), LDA.Setting("high_beta", 50 / TOPICS, 0.5)]


class Topics:
    """A fit on the stop-word-trimmed counts of all documents over the whole vocabulary."""

    def __init__(self, spark, sf_dir, settings):
        self.docs = Tables(spark, sf_dir).documents.select("doc_id", "text")
        self.rows, self.words = SR.count_rows(self.docs, "doc_id", STOP_WORDS)
        self.settings, self.n_words = settings, self.words.count()
        self.state, self.counts, self.trace = LDA.fit(self.rows, self.n_words, TOPICS, settings, SWEEPS, LOCAL_SWEEPS, LDA_SEED)
        forget(self.rows)

    def of_documents(self, found, keys=("setting",)):
        """Every document has a row: one without words has equal shares."""
        every = self.docs.select("doc_id")
        if keys:
            every = every.withColumn("setting", F.explode(F.array(*[F.lit(s.name) for s in self.settings])))
        even = F.array_repeat(F.lit(1.0 / TOPICS), TOPICS)
        found = found.withColumnRenamed("id", "doc_id")
        return every.join(found, ["doc_id", *keys], "left").withColumn("distribution", F.coalesce("distribution", even))


@query("lda_fit", rows=("M1", "M5", "M7"))
def lda_fit(spark, sf_dir):
    """Topic model (10 topics, collapsed Gibbs sampling, 200 sweeps) at low and high concentrations of
    topics in a document and of words in a topic, all settings in the same rounds: each document's
    topic distribution and its heaviest topic."""
    t = Topics(spark, sf_dir, LDA_SETTINGS)
    found = t.of_documents(LDA.distributions(t.state, t.settings, TOPICS))
    best = F.array_max(F.transform("distribution", lambda v, i: F.struct(v.alias("w"), (-i).alias("ni"))))
    return found.select("setting", "doc_id", "distribution", (-best["ni"]).cast("bigint").alias("topic"), best["w"].alias("weight"))


@query("lda_likelihood", rows=("M1", "M7"))
def lda_likelihood(spark, sf_dir):
    """Log likelihood of the words given the topics after every round of sweeps."""
    t = Topics(spark, sf_dir, [_PRIOR])
    forget(t.state)
    return spark.createDataFrame([(done, float(ll[0])) for done, ll in t.trace], "sweeps bigint, loglik double")


@query("lda_neighbours", rows=("M9",))
def lda_neighbours(spark, sf_dir):
    """Retrieval on topic vectors: the 5 documents with the nearest topic distribution (cosine)
    for every document whose id is divisible by 50."""
    from tessera.operators.block_search import search
    t = Topics(spark, sf_dir, [_PRIOR])
    found = cut_lineage(t.of_documents(LDA.distributions(t.state, t.settings, TOPICS)).select("doc_id", F.col("distribution").alias("vec")))
    forget(t.state)
    near = search(found.select(F.col("doc_id").alias("row"), F.lit(0).alias("label"), "vec"),
                  found.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "vec"), 6, metric="cosine")
    others = near.where(F.col("query_id") != F.col("row"))
    return topk_per_group(others, "query_id", [F.col("distance"), F.col("row")], 5).select(
        "query_id", F.col("row").alias("doc_id"), "rank", F.round("distance", 6).alias("distance"))


@query("lda_topics", rows=("M2",))
def lda_topics(spark, sf_dir):
    """Ten most probable words of each topic with their weights (topic rows sum to at most 1)."""
    t = Topics(spark, sf_dir, [_PRIOR])
    forget(t.state)
    share = LDA.word_shares(t.counts[0], _PRIOR.beta)
    parts = []
    for k in range(TOPICS if len(share) else 0):
        last = max(len(share) - 10, 0)
        at = np.flatnonzero(share[:, k] >= np.partition(share[:, k], last)[last])       # with all ties
        parts.append(pa.table({"topic": np.full(len(at), k), "number": at.astype(np.int32), "weight": share[at, k]}))
    if not parts:
        return spark.createDataFrame([], "topic bigint, rank bigint, word string, weight double")
    named = spark.createDataFrame(pa.concat_tables(parts)).join(t.words.select("number", "word"), "number")
    return topk_per_group(named, "topic", [F.desc("weight"), F.col("word")], 10).select("topic", "rank", "word", "weight")


@query("lda_average", rows=("M6",))
def lda_average(spark, sf_dir):
    """Topic distribution of each document under the fitted topics, averaged over 100 random draws
    of its words' topics, sorted."""
    t = Topics(spark, sf_dir, [_PRIOR])
    drawn = LDA.average_prediction(t.state, LDA.word_shares(t.counts[0], _PRIOR.beta), _PRIOR.alpha, DRAWS, BURN, LDA_SEED)
    return t.of_documents(drawn, ()).select("doc_id", F.sort_array("distribution", asc=False).alias("avg_sorted"))
