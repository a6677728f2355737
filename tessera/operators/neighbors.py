"""Exact nearest-neighbour search.

* Sparse (bag-of-words / TF-IDF) cosine top-k: queries go in blocks of a bounded number; the
  documents keep only the block's words, every task multiplies its documents with the block
  and sends on the k nearest of each query. ``sparse_cosine_scores`` gives all pairs that
  share a word, where a result is about all of them.
* Dense: queries go in blocks of a bounded number; a block's vectors are embedded in one
  projection over the corpus, one distance per query, then the same per-query top-k.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vectors as V

MAX_DENSE_QUERIES = 4096
SPARSE_BLOCK = 256         # queries of a block
SPARSE_WEIGHTS = 1 << 16   # words of all its queries, about


def topk_per_group(df: DataFrame, group: str, order_cols: list, k: int,
                   rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def sparse_cosine_scores(q: DataFrame, c: DataFrame, qid: str, cid: str,
                         weight: str = "tfidf") -> DataFrame:
    """(qid, cid, distance) for every pair sharing at least one word.

    ``q`` and ``c`` are long-form (id, word, weight). Cosine distance = 1 - q·c/(|q||c|).
    """
    qv = q.select(qid, "word", F.col(weight).alias("qw"))
    cv = c.select(cid, "word", F.col(weight).alias("cw"))
    qn = qv.groupBy(qid).agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    cn = cv.groupBy(cid).agg(F.sqrt(F.sum(F.col("cw") * F.col("cw"))).alias("cnorm"))
    dots = (qv.join(cv, "word")
            .groupBy(qid, cid).agg(F.sum(F.col("qw") * F.col("cw")).alias("dot")))
    return (dots.join(qn, qid).join(cn, cid)
            .select(qid, cid, (F.lit(1.0) - F.col("dot") / (F.col("qnorm") * F.col("cnorm")))
                    .alias("distance")))


def _sparse_block(shared, k: int):
    def run(batches):
        ids, weights, norms = shared.value            # weights: (words, queries)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            doc, norm = batch.column("cid").to_numpy(), batch.column("norm").to_numpy()
            size = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
            word = batch.column("words").flatten().to_numpy(zero_copy_only=False)
            value = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size)])
            step = max(1, (1 << 22) // len(weights))      # a matrix of bounded size
            for lo in range(0, len(doc), step):
                hi = min(lo + step, len(doc))
                row = np.repeat(np.arange(hi - lo), size[lo:hi])
                m = np.zeros((hi - lo, len(weights)))
                m[row, word[at[lo]:at[hi]]] = value[at[lo]:at[hi]]
                shares = (m != 0).astype(np.float32) @ (weights != 0).astype(np.float32) > 0
                dist = np.where(shares, 1.0 - (m @ weights) / (norm[lo:hi, None] * norms), np.inf).T
                near = np.round(dist, 9)
                far = np.partition(near, min(k, hi - lo) - 1, axis=1)[:, min(k, hi - lo) - 1]
                q, d = np.nonzero((near <= far[:, None]) & np.isfinite(near))    # all ties of the last place
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(doc[lo + d]), pa.array(dist[q, d])],
                                                 ["qid", "cid", "distance"])
    return run


def sparse_cosine_topk(q: DataFrame, c: DataFrame, qid: str, cid: str, k: int,
                       weight: str = "tfidf", block: int = SPARSE_BLOCK) -> DataFrame:
    """(qid, cid, distance, rank) of the k nearest documents of each query among those that share
    a word with it; ties by document."""
    sc = c.sparkSession.sparkContext
    qv = q.select(F.col(qid).cast("bigint").alias("qid"), "word", F.col(weight).cast("double").alias("w")).where("w != 0")
    cv = c.select(F.col(cid).cast("bigint").alias("cid"), "word", F.col(weight).cast("double").alias("w")).where("w != 0")
    norms = cv.groupBy("cid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    size = qv.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("qid").alias("n")).first()
    n = max(1, -(-size["n"] // block), -(-size["rows"] // SPARSE_WEIGHTS))
    out = None
    for b in range(n):
        rows = qv.where(F.pmod(F.xxhash64("qid"), F.lit(n)) == b).toArrow()     # one block of queries
        if rows.num_rows == 0:
            continue
        ids, which = np.unique(rows.column("qid").to_numpy(), return_inverse=True)
        words, place = np.unique(rows.column("word").to_numpy(), return_inverse=True)
        weights = np.zeros((len(words), len(ids)))
        weights[place, which] = rows.column("w").to_numpy()
        numbers = c.sparkSession.createDataFrame(list(zip(words.tolist(), range(len(words)))), "word string, i int")
        docs = (cv.join(F.broadcast(numbers), "word")                            # the block's words
                .groupBy("cid").agg(F.collect_list(F.struct("i", "w")).alias("l"))
                .select("cid", F.col("l.i").alias("words"), F.col("l.w").alias("values")).join(norms, "cid"))
        found = docs.mapInArrow(_sparse_block(sc.broadcast((ids, weights, np.sqrt((weights ** 2).sum(axis=0)))), k),
                                "qid bigint, cid bigint, distance double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = c.sparkSession.createDataFrame([], "qid bigint, cid bigint, distance double")
    top = topk_per_group(out, "qid", [F.round("distance", 9), F.col("cid")], k)
    return top.select(F.col("qid").alias(qid), F.col("cid").alias(cid), "distance", "rank")


def collect_bounded(df: DataFrame, max_rows: int = MAX_DENSE_QUERIES) -> list:
    """Collect a frame that must be model-sized; refuses (never truncates) above the bound."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"query set exceeds {max_rows} rows; use the LSH search path")
    return rows


def dense_distances(corpus: DataFrame, vec_col: str, queries: list[tuple], metric: str,
                    keep: list[str]) -> DataFrame:
    """One row per (corpus row, query) with the distance; queries = [(qid, vector)].
    The distances of a row to all queries come from one batched numpy pass."""
    qids = F.array(*[F.lit(q).cast("bigint") for q, _ in queries])
    pts = [v for _, v in queries]
    if metric == "euclidean":
        dist = F.transform(V.sq_dists_to(vec_col, pts), lambda x: F.sqrt(x))
    elif metric == "cosine":
        norms = F.array(*[F.lit(V.seq_norm(v)) for v in pts])
        vn = V.norm(vec_col)
        dist = F.zip_with(V.dots_to(vec_col, pts), norms, lambda d, qn: F.lit(1.0) - d / (vn * qn))
    else:
        raise ValueError(metric)
    return (corpus.select(*keep, F.posexplode(dist).alias("qpos", "distance"))
            .select(*keep, F.element_at(qids, F.col("qpos") + 1).alias("query_id"), "distance"))


def dense_knn(corpus: DataFrame, id_col: str, vec_col: str, queries: DataFrame,
              qid_col: str, qvec_col: str, k: int, metric: str = "euclidean",
              keep: list[str] | None = None) -> DataFrame:
    """(query_id, id, distance, rank) for the k nearest corpus rows of each query."""
    keep = [id_col] + (keep or [])
    q = queries.select(qid_col, qvec_col)
    blocks = max(1, -(-q.count() // MAX_DENSE_QUERIES))     # one pass over the corpus per block
    d = None
    for b in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64(qid_col), F.lit(blocks)) == b)
        qrows = [(r[qid_col], [float(x) for x in r[qvec_col]]) for r in part.toLocalIterator()]
        if qrows:
            found = dense_distances(corpus, vec_col, qrows, metric, keep)
            d = found if d is None else d.unionByName(found)
    if d is None:
        d = corpus.where("false").select(*keep, F.lit(0).cast("bigint").alias("query_id"), F.lit(0.0).alias("distance"))
    return topk_per_group(d, "query_id", [F.round("distance", 9), F.col(id_col)], k)
