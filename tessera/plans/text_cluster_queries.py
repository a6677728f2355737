"""k-means on TF-IDF text vectors and cluster profiles.

Fixtures (fixed values): unit-norm TF-IDF of all documents (unsmoothed idf; documents without a
weighted word belong to no cluster); starts: the 5 documents with the smallest
md5(doc_id:seed), seed 61 (61 .. 67 for the comparison of starts); three iterations where the
result is checked against SQL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash32, sql_hash32, sql_uniform, uniform
from tessera.functions.text import WHITESPACE
from tessera.operators import packed_gmm as PG
from tessera.operators import packed_kmeans as PK
from tessera.operators import sparse_gmm as SG
from tessera.operators import sparse_kmeans as SK
from tessera.operators import sparse_rows as SR
from tessera.operators.neighbors import topk_per_group
from tessera.plans.sqlbits import WS, idf_sql, word_counts_sql
from tessera.registry import query
from tessera.session import cut_lineage, forget
from tessera.sources.tables import Tables

K, SEED, ITERS, SEEDS, MAX_ITER = 5, 61, 3, tuple(range(61, 68)), 400
TOP_WORDS, TOP_DOCS, SNIPPET = 5, 8, 25


class Texts:
    """Unit TF-IDF rows of all documents: a table, packed blocks (for ``many`` passes of rows dealt
    evenly), and the vocabulary."""

    def __init__(self, spark, sf_dir, many: bool = False):
        self.rows, self.words = SR.tfidf_rows(Tables(spark, sf_dir).documents, "doc_id")
        self.blocks = SR.pack(SR.dealt(self.rows) if many else self.rows)
        self.n_words = self.words.count()

    def centroids(self, ids: list[int], k: int):
        """Chosen documents as centroids (words, k); missing ones are zero."""
        return PK.dense(self.rows, [*ids, *[-1] * (k - len(ids))], self.n_words)

    def first(self, seed: int, k: int, members=None) -> list[int]:
        """The k documents with the smallest hash, of ``members`` (id) or of all."""
        ids = self.rows.select("id") if members is None else members
        return [r["id"] for r in ids.orderBy(hash32("id", seed), "id").limit(k).collect()]     # k ids

    def runs(self, seeds, k: int, branch: str = "", members=None) -> list[PK.Run]:
        return [PK.Run(self.centroids(self.first(s, k, members), k), branch) for s in seeds]

    def close(self) -> None:
        self.blocks.unpersist()
        forget(self.rows, self.words)


def _long_rows(t: Texts):
    """The rows as (id, word, w), dealt by word."""
    long = t.rows.select("id", F.explode(F.arrays_zip("cols", "vals")).alias("e")).select("id", F.col("e.cols").alias("word"), F.col("e.vals").alias("w"))
    return SK.by_word(long, t.rows.agg(F.sum(F.size("cols"))).first()[0] or 0)


def joined_runs(t: Texts, seeds, max_iter: int):
    """The runs by the joined form, for vocabularies whose centroids no task can hold."""
    long, ids = _long_rows(t), None
    for s in seeds:
        chosen = t.rows.sparkSession.createDataFrame([(s, i, d) for i, d in enumerate(t.first(s, K))], "run int, k int, id bigint")
        ids = chosen if ids is None else ids.unionByName(chosen)
    cents, members, trace = SK.lloyd(long, SK.start(long, ids), list(seeds), K, max_iter)
    return long, cents, members, trace


def _sql(iters: int) -> str:
    parts = [f"""dw AS MATERIALIZED ({word_counts_sql('documents', 'doc_id')}),
idf AS ({idf_sql('dw', 'documents')}),
dt AS (SELECT doc_id, word, count * idf AS w FROM dw JOIN idf USING (word)),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM dt GROUP BY doc_id),
u AS MATERIALIZED (SELECT doc_id, word, w / n AS w FROM dt JOIN nrm USING (doc_id) WHERE n > 0),
x AS (SELECT doc_id, sum(w * w) AS x2 FROM u GROUP BY doc_id),
ids AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_hash32('doc_id', SEED)}, doc_id) - 1 AS k
        FROM (SELECT DISTINCT doc_id FROM u) QUALIFY k < {K}),
ks AS (SELECT unnest(range({K})) AS k),
c0 AS MATERIALIZED (SELECT k, word, w AS c FROM u JOIN ids USING (doc_id))"""]
    for t in range(iters + 1):
        parts.append(f"""
dot{t} AS (SELECT doc_id, k, sum(u.w * c.c) AS dot FROM u JOIN c{t} c USING (word) GROUP BY doc_id, k),
n{t} AS (SELECT k, sum(c * c) AS n FROM c{t} GROUP BY k),
a{t} AS MATERIALIZED (SELECT doc_id, k, d FROM (
  SELECT x.doc_id, ks.k, round(x2 - 2 * coalesce(dot, 0) + coalesce(n, 0), 9) AS d,
         row_number() OVER (PARTITION BY x.doc_id ORDER BY round(x2 - 2 * coalesce(dot, 0) + coalesce(n, 0), 9), ks.k) AS rn
  FROM x CROSS JOIN ks LEFT JOIN dot{t} dt ON dt.doc_id = x.doc_id AND dt.k = ks.k LEFT JOIN n{t} nn ON nn.k = ks.k) WHERE rn = 1),
s{t} AS (SELECT k, count(*) AS n FROM a{t} GROUP BY k),
c{t + 1} AS MATERIALIZED (SELECT a.k, u.word, sum(u.w) / any_value(s.n) AS c FROM u JOIN a{t} a USING (doc_id) JOIN s{t} s ON s.k = a.k
  GROUP BY a.k, u.word UNION ALL SELECT * FROM c{t} WHERE k NOT IN (SELECT k FROM s{t}))""")
    return ",".join(parts)


def _trace_sql(iters: int) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT {t}::BIGINT AS iteration, round((SELECT sum(w * w) FROM u) -
  (SELECT sum(s.n * q) FROM s{t} s JOIN (SELECT k, sum(c * c) AS q FROM c{t + 1} GROUP BY k) USING (k)), 6) AS heterogeneity,
  {'NULL::BIGINT' if t == 0 else f'(SELECT count(*) FROM a{t} JOIN a{t - 1} p USING (doc_id) WHERE a{t}.k <> p.k)::BIGINT'} AS changed"""
        for t in range(iters))


@query("kmeans_text", rows=("K1", "K2", "K3", "K4", "K5"), oracle=f"WITH {_sql(ITERS)}\n{_trace_sql(ITERS)}")
def kmeans_text(spark, sf_dir):
    """Lloyd iterations over TF-IDF texts: heterogeneity and changed assignments."""
    t = Texts(spark, sf_dir)
    if PK.fits(t.n_words, K):
        (run,) = runs = t.runs([SEED], K)
        PK.lloyd(t.blocks, runs, ITERS)
        trace = run.trace
    else:
        trace = [x[1:] for x in joined_runs(t, [SEED], ITERS)[3]]
    t.close()
    return spark.createDataFrame([(it, round(h, 6), ch) for it, h, ch in trace],
                                 "iteration bigint, heterogeneity double, changed bigint")


def _profile(spark, sf_dir):
    """Texts, and (id, cluster, sq_dist) of all documents after the iterations."""
    t = Texts(spark, sf_dir)
    if PK.fits(t.n_words, K):
        (run,) = runs = t.runs([SEED], K)
        PK.lloyd(t.blocks, runs, ITERS)
        return t, PK.assign(t.blocks, run.centroids).drop("branch")
    long, cents, _, _ = joined_runs(t, [SEED], ITERS)
    return t, SK.assign(long, cents, [SEED], K).drop("run")


def _named(t: Texts, means, group: str, n: int):
    """Of (group, number, mean, ..) each group's rows at or above its n-th mean, with their words: only
    these meet the vocabulary."""
    at = F.rank().over(Window.partitionBy(group).orderBy(F.desc(F.round("mean", 9))))
    return means.withColumn("_at", at).where(F.col("_at") <= n).drop("_at").join(t.words.select("number", "word"), "number")


@query("text_cluster_words", rows=("K10", "K21"), oracle=f"""WITH {_sql(ITERS)},
m AS (SELECT a.k, u.word, sum(u.w) / any_value(s.n) AS mean, sum(u.w * u.w) / any_value(s.n) AS sq
      FROM u JOIN a{ITERS} a USING (doc_id) JOIN s{ITERS} s ON s.k = a.k GROUP BY a.k, u.word)
SELECT k::BIGINT AS cluster, rk::BIGINT AS rank, word, round(mean, 6) AS mean, round(sq - mean * mean, 6) AS variance FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(mean, 9) DESC, word) AS rk FROM m) WHERE rk <= {TOP_WORDS}""")
def text_cluster_words(spark, sf_dir):
    """Five heaviest words of each text cluster with the mean and variance of their weight over
    the cluster's documents."""
    t, members = _profile(spark, sf_dir)
    members = cut_lineage(members.select("id", "cluster"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).persist()
    n = sum(r["n"] for r in sizes.collect())                                                    # K rows
    long = t.rows.join(SK.shared(members, n), "id").select("cluster", F.explode(F.arrays_zip("cols", "vals")).alias("e"))
    m = (long.groupBy("cluster", F.col("e.cols").alias("number"))
         .agg(F.sum("e.vals").alias("s"), F.sum(F.col("e.vals") * F.col("e.vals")).alias("q")).join(F.broadcast(sizes), "cluster")
         .select("cluster", "number", (F.col("s") / F.col("n")).alias("mean"), (F.col("q") / F.col("n")).alias("sq")))
    top = topk_per_group(_named(t, m, "cluster", TOP_WORDS), "cluster", [F.desc(F.round("mean", 9)), F.col("word")], TOP_WORDS)
    return top.select("cluster", "rank", "word", F.round("mean", 6).alias("mean"),
                      F.round(F.col("sq") - F.col("mean") * F.col("mean"), 6).alias("variance"))


@query("text_cluster_docs", rows=("K10",), oracle=f"""WITH {_sql(ITERS)}
SELECT k::BIGINT AS cluster, rk::BIGINT AS rank, doc_id, round(d, 6) AS sq_dist,
  array_to_string(list_filter(string_split_regex(text, '{WS}'), lambda s: s <> '')[1:{SNIPPET}], ' ') AS snippet FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY d, doc_id) AS rk FROM a{ITERS}) JOIN documents USING (doc_id)
WHERE rk <= {TOP_DOCS}""")
def text_cluster_docs(spark, sf_dir):
    """Eight documents nearest to each text cluster's centroid, with their first words."""
    _, members = _profile(spark, sf_dir)
    top = topk_per_group(members, "cluster", [F.col("sq_dist"), F.col("id")], TOP_DOCS)
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text")
    words = F.filter(F.split("text", WHITESPACE), lambda w: w != "")
    return (top.join(docs, top["id"] == docs["doc_id"])
            .select("cluster", "rank", "doc_id", F.round("sq_dist", 6).alias("sq_dist"),
                    F.array_join(F.slice(words, 1, SNIPPET), " ").alias("snippet")))


@query("kmeans_text_seeds", rows=("K6", "K8"))
def kmeans_text_seeds(spark, sf_dir):
    """Text k-means from seven starts, all runs in the same passes, until no document changes
    (at most 400 iterations): heterogeneity, largest cluster, iterations and the best run."""
    t = Texts(spark, sf_dir, many=True)
    if PK.fits(t.n_words, K):
        runs = t.runs(SEEDS, K)
        PK.lloyd(t.blocks, runs, MAX_ITER)
        found = [(s, r.trace[-1][1], int(r.sizes.max()), r.trace[-1][0] + 1) for s, r in zip(SEEDS, runs) if r.trace]
    else:
        _, _, members, trace = joined_runs(t, SEEDS, MAX_ITER)
        sizes = members.groupBy("run", "cluster").agg(F.count(F.lit(1)).alias("n")).groupBy("run").agg(F.max("n").alias("n")).collect()
        last = {r: (it, h) for r, it, h, _ in trace}
        found = [(r["run"], last[r["run"]][1], r["n"], last[r["run"]][0] + 1) for r in sizes]
    t.close()
    best = min(found, key=lambda r: (r[1], r[0]))[0] if found else None
    return spark.createDataFrame([(s, float(h), n, it, s == best) for s, h, n, it in found],
                                 "seed bigint, heterogeneity double, largest_cluster bigint, iterations bigint, best boolean")


PP_SEED = 91
_PP = ["p0 AS (SELECT 0 AS r, doc_id FROM x ORDER BY " + sql_hash32("doc_id", PP_SEED) + ", doc_id LIMIT 1)"]
for _r in range(1, K):
    _PP.append(f"""c{_r} AS (SELECT x.doc_id, min(round(x2 + y2 - 2 * coalesce(dot, 0), 9)) AS d FROM x
  CROSS JOIN (SELECT p.doc_id AS c, x.x2 AS y2 FROM ({' UNION ALL '.join(f'SELECT * FROM p{j}' for j in range(_r))}) p JOIN x USING (doc_id)) y
  LEFT JOIN (SELECT a.doc_id, b.doc_id AS c, sum(a.w * b.w) AS dot FROM u a JOIN u b USING (word)
    WHERE b.doc_id IN ({' UNION ALL '.join(f'SELECT doc_id FROM p{j}' for j in range(_r))}) GROUP BY ALL) z ON z.doc_id = x.doc_id AND z.c = y.c GROUP BY x.doc_id),
p{_r} AS (SELECT {_r} AS r, doc_id FROM c{_r} WHERE d > 0 ORDER BY ln({sql_uniform('doc_id', PP_SEED + _r)}) / d DESC, doc_id LIMIT 1)""")
_PP_SQL = f"""WITH {_sql(0).split('ids AS')[0].rstrip().rstrip(',')}, {', '.join(_PP)}
SELECT r::BIGINT AS round, doc_id FROM ({' UNION ALL '.join(f'SELECT * FROM p{j}' for j in range(K))})"""


@query("kmeans_pp_text", rows=("K7", "X7"), oracle=_PP_SQL)
def kmeans_pp_text(spark, sf_dir):
    """k-means++ centres among the TF-IDF texts: a document's distance to the nearest centre so
    far comes from one pass over the rows with the few centres; the draw in proportion to its
    square is the greatest log(u) / D^2, u a hash of the document."""
    t = Texts(spark, sf_dir)
    ids = t.first(PP_SEED, 1)
    for r in range(1, K):
        d = PK.assign(t.blocks, t.centroids(ids, len(ids))).where("sq_dist > 0")
        key = F.log(uniform("id", PP_SEED + r)) / F.col("sq_dist")
        ids += [x["id"] for x in d.orderBy(F.desc(key), "id").limit(1).collect()]
    t.close()
    return spark.createDataFrame(list(enumerate(ids)), "round bigint, doc_id bigint")


BISECT_RUNS, BISECT_ITER, BISECT_LEVELS = tuple(range(71, 77)), 100, 2
_BRANCHES = "branch string, n bigint, heterogeneity_after_split double"


def _joined_bipartition(t: Texts) -> list[tuple]:
    """The branches by the joined form, for vocabularies whose centroids no task can hold: a branch's rows
    are those of its members, and its runs advance in the same passes."""
    spark = t.rows.sparkSession
    long, out = _long_rows(t), []
    level = [("", cut_lineage(t.rows.select("id")))]
    for _ in range(BISECT_LEVELS):
        below = []
        for name, member in level:
            n = member.count()
            if n < 2:
                out.append((name, n, None))
                continue
            rows = long.join(SK.shared(member, n), "id", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
            ids = [(s, i, d) for s in BISECT_RUNS for i, d in enumerate(t.first(s, 2, member))]
            cents, _, trace = SK.lloyd(rows, SK.start(rows, spark.createDataFrame(ids, "run int, k int, id bigint")), list(BISECT_RUNS), 2, BISECT_ITER)
            last = {run: h for run, _, h, _ in trace}
            best = min(BISECT_RUNS, key=lambda run: last[run])
            out.append((name, n, float(last[best])))
            sides = cut_lineage(SK.assign(rows, cents.where(F.col("run") == best), [best], 2).select("id", "cluster"))
            rows.unpersist()
            below += [(name + str(c), sides.where(F.col("cluster") == c).select("id")) for c in range(2)]
        level = below
    long.unpersist()
    return out + [(name, member.count(), None) for name, member in level]


@query("bipartition_text", rows=("K11",))
def bipartition_text(spark, sf_dir):
    """Hierarchical clustering of the texts by repeated bipartition (k-means with two centres, the
    best of six starts, at most 100 iterations): the root and both its branches are split, all
    branches of a level in the same passes; size and heterogeneity of every branch (named by its
    path)."""
    t = Texts(spark, sf_dir, many=True)
    if not PK.fits(t.n_words, 2 * 2 ** BISECT_LEVELS):
        out = _joined_bipartition(t)
        t.close()
        return spark.createDataFrame(out, _BRANCHES)
    tree, out, level = {}, [], [""]
    zero = PK.dense(t.rows.limit(0), [-1], t.n_words)
    for _ in range(BISECT_LEVELS):
        member = PK.assign(t.blocks, zero, tree).select("id", "branch").persist()
        size = {r["branch"]: r["n"] for r in member.groupBy("branch").agg(F.count(F.lit(1)).alias("n")).collect()}
        split = [b for b in level if size.get(b, 0) >= 2]
        out += [(b, size.get(b, 0), None) for b in level if b not in split]
        runs = {b: t.runs(BISECT_RUNS, 2, b, member.where(F.col("branch") == b).select("id")) for b in split}
        member.unpersist()
        PK.lloyd(t.blocks, [r for b in split for r in runs[b]], BISECT_ITER, tree)
        best = {b: min(runs[b], key=lambda r: r.trace[-1][1]) for b in split}
        out += [(b, size[b], float(best[b].trace[-1][1])) for b in split]
        tree |= {b: best[b].centroids for b in split}
        level = [b + side for b in split for side in "01"]
    size = {r["branch"]: r["n"] for r in PK.assign(t.blocks, zero, tree).groupBy("branch").agg(F.count(F.lit(1)).alias("n")).collect()}
    t.close()
    return spark.createDataFrame(out + [(b, size.get(b, 0), None) for b in level], _BRANCHES)


# ------------------------------------------------------------------ diagonal EM on the texts

#: Variances count as at least this; EM stops at a gain below the second number.
EM_SMOOTHING, EM_GAIN, EM_MAX, EM_SEED, EM_WORDS = 1e-5, 1e-5, 100, 5, 5


def _kmeans_start(t: Texts):
    """The form for the vocabulary (packed, or dealt by word), the rows in it, and the mixture of the
    k-means clusters."""
    if PG.fits(t.n_words, K):
        (run,) = runs = t.runs([SEED], K)
        PK.lloyd(t.blocks, runs, ITERS)
        return PG, t.blocks, PG.from_clusters(t.blocks, run.centroids, EM_SMOOTHING)
    long, cents, _, _ = joined_runs(t, [SEED], ITERS)
    return SG, long, SG.from_clusters(long, SK.assign(long, cents, [SEED], K), K, EM_SMOOTHING)


_EM_SQL = f"""WITH {_sql(ITERS)},
v AS MATERIALIZED (SELECT DISTINCT word FROM u),
nd AS (SELECT count(*) AS nd FROM x),
em_p0 AS MATERIALIZED (SELECT k, word, coalesce(s1 / n, 0) AS mu, greatest(coalesce(s2 / n - (s1 / n) ^ 2, 0), {EM_SMOOTHING}) AS var
  FROM s{ITERS} CROSS JOIN v LEFT JOIN (SELECT a.k, u.word, sum(u.w) AS s1, sum(u.w * u.w) AS s2 FROM u JOIN a{ITERS} a USING (doc_id) GROUP BY ALL) z USING (k, word)),
em_b0 AS (SELECT k, ln(any_value(s.n) / any_value(nd)) - 0.5 * sum(ln(2 * pi() * var) + mu * mu / var) AS base FROM em_p0 JOIN s{ITERS} s USING (k), nd GROUP BY k),
em_j0 AS (SELECT u.doc_id, em_p0.k, any_value(base) + sum((u.w * mu - 0.5 * u.w * u.w) / var) AS lj FROM u JOIN em_p0 USING (word) JOIN em_b0 USING (k) GROUP BY u.doc_id, em_p0.k),
em_l0 AS (SELECT doc_id, max(lj) + ln(sum(exp(lj - m))) AS lse FROM (SELECT *, max(lj) OVER (PARTITION BY doc_id) AS m FROM em_j0) GROUP BY doc_id),
em_r0 AS MATERIALIZED (SELECT doc_id, k, exp(lj - lse) AS r FROM em_j0 JOIN em_l0 USING (doc_id)),
em_n0 AS (SELECT k, sum(r) AS nk FROM em_r0 GROUP BY k),
em_m1 AS (SELECT k, word, s1 / nk AS mean, greatest(s2 / nk - (s1 / nk) ^ 2, {EM_SMOOTHING}) AS var FROM (
  SELECT k, word, sum(r * w) AS s1, sum(r * w * w) AS s2 FROM u JOIN em_r0 USING (doc_id) GROUP BY ALL) JOIN em_n0 USING (k))
SELECT k::BIGINT AS component, round(nk / nd, 6) AS weight, rk::BIGINT AS rank, word, round(mean, 6) AS mean, round(var, 6) AS variance,
  round((SELECT sum(lse) FROM em_l0) / nd / (SELECT count(*) FROM v), 6) AS loglik_per_word
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(mean, 9) DESC, word) AS rk FROM em_m1) JOIN em_n0 USING (k), nd WHERE rk <= {EM_WORDS}"""


def _component_words(spark, t: Texts, mix: PG.Mixture | SG.Mixture, n: int):
    """The n heaviest words of each component, ties by word: (component, rank, word, mean, variance).
    Only words at or above a component's n-th mean meet the vocabulary."""
    if isinstance(mix, SG.Mixture):
        cells = [F.struct(F.lit(c).alias("component"), F.col(f"m{c}").alias("mean"), F.col(f"v{c}").alias("variance")) for c in range(len(mix.weights))]
        named = cut_lineage(_named(t, mix.words.select(F.col("word").alias("number"), F.inline(F.array(*cells))), "component", n))
    else:
        parts = []
        for c in range(mix.means.shape[1]):
            m = np.round(mix.means[:, c], 9)
            at = np.flatnonzero(m >= np.partition(m, max(len(m) - n, 0))[max(len(m) - n, 0)]) if len(m) else np.zeros(0, int)
            parts.append(pa.table({"component": np.full(len(at), c), "number": at.astype(np.int32), "mean": mix.means[at, c], "variance": mix.variances[at, c]}))
        named = spark.createDataFrame(pa.concat_tables(parts)).join(t.words.select("number", "word"), "number")
    top = topk_per_group(named, "component", [F.desc(F.round("mean", 9)), F.col("word")], n)
    return top.select(F.col("component").cast("bigint").alias("component"), "rank", "word", F.round("mean", 6).alias("mean"),
                      F.round("variance", 6).alias("variance"))


@query("em_text_step", rows=("K18", "K19", "K21"), oracle=_EM_SQL)
def em_text_step(spark, sf_dir):
    """One diagonal EM step on the TF-IDF texts from the text k-means (means, shares, variances of
    its clusters): new weights, the heaviest words with mean and variance, and the log likelihood
    before the step per document and word of the vocabulary."""
    t = Texts(spark, sf_dir)
    n = t.rows.count()
    form, rows, start = _kmeans_start(t)
    mix, ll = form.em_step(rows, start, EM_SMOOTHING)
    out = _component_words(spark, t, mix, EM_WORDS)
    w = spark.createDataFrame([(c, round(float(x), 6)) for c, x in enumerate(mix.weights)], "component bigint, weight double")
    out = out.join(F.broadcast(w), "component").withColumn("loglik_per_word", F.lit(round(ll / n / t.n_words, 6)))
    rows.unpersist()
    return out.where("weight > 0")


@query("em_text", rows=("K15", "K19", "K20"))
def em_text(spark, sf_dir):
    """Diagonal EM on the TF-IDF texts until it gains less than 1e-5 (at most 100 steps), from the
    text k-means and from normal means with variances 1 to 5: log likelihood before every step."""
    t = Texts(spark, sf_dir, many=True)
    form, rows, start = _kmeans_start(t)
    random = PG.random_start(t.n_words, K, EM_SEED) if form is PG else SG.random_start(spark, t.n_words, K, EM_SEED)
    found = []
    for name, first in (("kmeans", start), ("random", random)):
        _, trace = form.em(rows, first, EM_SMOOTHING, EM_GAIN, EM_MAX)
        found += [(name, it, float(ll)) for it, ll in enumerate(trace)]
    rows.unpersist()
    t.close()
    return spark.createDataFrame(found, "start string, iteration bigint, loglik double")


@query("em_text_words", rows=("K21", "L5"))
def em_text_words(spark, sf_dir):
    """Heaviest words of each component, with mean and variance, after EM from the text k-means."""
    t = Texts(spark, sf_dir, many=True)
    form, rows, start = _kmeans_start(t)
    mix, _ = form.em(rows, start, EM_SMOOTHING, EM_GAIN, EM_MAX)
    out = _component_words(spark, t, mix, EM_WORDS)
    rows.unpersist()
    return out
