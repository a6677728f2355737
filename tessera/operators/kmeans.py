"""k-means over array-valued rows: assignment, centroid revision, heterogeneity, k-means++.

Centroids are model state (k × d) that goes along with the tasks; each Lloyd iteration is
one scan of rows packed once: nearest centroid (first index wins ties), the previous
assignment for the change count, the heterogeneity of the previous step, and per-cluster
vector sums for the next centroids. Several starts share the scans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.functions.hashing import hash32, uniform
from tessera.operators.arrays import SCHEMA, packed, sum_arrays


def sq_dists(vec: Column, centroids: np.ndarray) -> Column:
    return V.sq_dists_to(vec, centroids)


def nearest(vec: Column, centroids: np.ndarray) -> Column:
    """struct(v = squared distance, i = index) of the nearest centroid; lowest index on ties."""
    d = sq_dists(vec, centroids)
    return F.array_min(F.transform(d, lambda x, i: F.struct(x.alias("v"), i.alias("i"))))


def cluster_sums(df: DataFrame, vec: str, cluster: Column) -> dict[int, tuple[int, np.ndarray]]:
    rows = (df.select(cluster.alias("_k"), array_to_vector(F.col(vec)).alias("_v"))
            .groupBy("_k").agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col("_v")).alias("s"))
            .collect())
    return {r["_k"]: (r["n"], r["s"].toArray()) for r in rows}


def revise(old: np.ndarray, sums: dict) -> np.ndarray:
    """Mean of each cluster's members; an empty cluster keeps its old centroid."""
    new = old.copy()
    for k, (n, s) in sums.items():
        if n:
            new[k] = s / n
    return new


PACK_ROWS = 4096            # of a packed block
COLLECT_BYTES = 8 << 20     # of all tasks' sums that the driver takes in one job


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)


def _nearest_of(x: np.ndarray, square: np.ndarray, c: np.ndarray) -> np.ndarray:
    """argmin of ``_squared`` by row: a product of matrices where its error can't matter, the
    differences themselves where the two nearest centroids are about as near (or not numbers)."""
    if len(c) == 1:
        return np.zeros(len(x), dtype=np.int64)
    norms = (c * c).sum(axis=1)
    d = square[:, None] - 2 * (x @ c.T) + norms
    near = d.argmin(axis=1)
    two = np.partition(d, 1, axis=1)
    close = np.flatnonzero(~(two[:, 1] - two[:, 0] > 1e-9 * (square + norms.max())))
    near[close] = _squared(x[close], c).argmin(axis=1)
    return near


def _pack(batches):
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
        for lo in range(0, len(x), PACK_ROWS):
            part = x[lo:lo + PACK_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["n", "x"])


def _passes(cur: dict[int, np.ndarray], prev: dict[int, np.ndarray]):
    """One scan of packed rows for all runs: per run the members' count and sum of each cluster,
    and against the previous centroids the changed rows and the heterogeneity of the previous
    assignment about the current means."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, x in zip(batch.column("n").to_pylist(), batch.column("x")):
                part = np.frombuffer(x.as_buffer(), np.float64).reshape(n, -1)
                square = (part * part).sum(axis=1)
                for r, c in cur.items():
                    k, d = c.shape
                    near = _nearest_of(part, square, c)
                    sums = np.array([part[near == j].sum(axis=0) for j in range(k)])
                    changed = het = 0.0
                    if r in prev:
                        old = _nearest_of(part, square, prev[r])
                        changed, het = float((old != near).sum()), float(((part - c[old]) ** 2).sum(axis=1).sum())
                    got = np.concatenate([[changed, het], np.bincount(near, minlength=k), sums.ravel()])
                    total[r] = total[r] + got if r in total else got
        if total:
            yield packed(total)
    return run


def lloyd_runs(df: DataFrame, vec: str, init: dict[int, np.ndarray], max_iter: int) -> dict[int, tuple]:
    """Lloyd iterations of several starts in the same scans: assign, revise, stop a run when no
    assignment changes; record heterogeneity (new centroids, current assignment) and change
    count. A record's heterogeneity is read in the following scan. Returns by run
    (centroids, trace[(iteration, heterogeneity, changed or None)])."""
    rows = df.select(F.col(vec).alias("v")).mapInArrow(_pack, "n bigint, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    tasks = rows.rdd.getNumPartitions()
    cur = {r: np.asarray(c, dtype=float) for r, c in init.items()}
    prev: dict[int, np.ndarray] = {}
    traces: dict[int, list] = {r: [] for r in cur}
    done: dict[int, tuple] = {}
    for it in range(max_iter + 1):
        live = {r: c for r, c in cur.items() if r not in done}
        if not live:
            break
        size = tasks * sum(8 * (2 + len(c) + c.size) for c in live.values())
        sums = sum_arrays(rows.mapInArrow(_passes(live, {r: prev[r] for r in live if r in prev}), SCHEMA), size <= COLLECT_BYTES)
        for r, c in live.items():
            k, d = c.shape
            got = sums.get(r, np.zeros(2 + k + k * d))
            changed = int(got[0]) if r in prev else None
            if traces[r]:
                traces[r][-1][1] = float(got[1])
            if it == max_iter or (r in prev and changed == 0):
                done[r] = (c, [tuple(t) for t in traces[r]])
                continue
            n, s = got[2:2 + k], got[2 + k:].reshape(k, d)
            prev[r] = c
            cur[r] = revise(c, {j: (n[j], s[j]) for j in range(k)})
            traces[r].append([it, None, changed])
    rows.unpersist()
    return done


def lloyd(df: DataFrame, vec: str, init: np.ndarray, max_iter: int):
    """Lloyd iterations from one start: (centroids, trace)."""
    return lloyd_runs(df, vec, {0: init}, max_iter)[0]


def assign(df: DataFrame, vec: str, centroids: np.ndarray) -> DataFrame:
    n = nearest(F.col(vec), centroids)
    return df.withColumn("cluster", n["i"].cast("bigint")).withColumn("sq_dist", n["v"])


def heterogeneity(df: DataFrame, vec: str, centroids: np.ndarray) -> float:
    return df.agg(F.sum(nearest(F.col(vec), centroids)["v"])).collect()[0][0]


def kmeans_pp(df: DataFrame, key: str, vec: str, k: int, seed: int) -> list:
    """k-means++ seeding with one pass per centre: the first centre has the smallest
    hash; each next centre maximises log(u)/D² (Efraimidis–Spirakis weighted draw with
    weight D², the squared distance to the nearest chosen centre), u a hash uniform."""
    v = F.col(vec)
    first = df.select(key, vec).orderBy(hash32(key, seed), key).limit(1).collect()[0]
    chosen = [first[key]]
    centres = [np.array(first[vec], dtype=float)]
    for r in range(1, k):
        d2 = F.array_min(sq_dists(v, np.array(centres)))
        score = F.when(d2 > 0, F.log(uniform(key, seed + r)) / d2)
        best = (df.select(key, vec, score.alias("s")).where(F.col("s").isNotNull())
                .orderBy(F.desc("s"), key).limit(1).collect()[0])
        chosen.append(best[key])
        centres.append(np.array(best[vec], dtype=float))
    return list(zip(chosen, centres))
