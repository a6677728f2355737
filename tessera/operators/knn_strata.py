"""Exact k-nearest-neighbour search for 2-d data with one discrete axis — no cross join,
no all-pairs table.

Rows are points (s, t) where ``s`` takes few distinct values (a stratum, e.g. a size code)
and ``t`` is continuous and unique. Within one stratum every reference row has the same
s-distance to a query, so its nearest rows there are those with the closest t: at most k
on each side of the query's insertion position in that stratum's t order. The global k
nearest are therefore among 2k candidates per (query, stratum):

1. positions: one distributed prefix count along (stratum, t) over the reference rows and
   the queries replicated to every stratum (a multiplier bounded by the number of distinct
   strata, checked, not by the data) gives each reference row its rank in its stratum and
   each query its insertion position;
2. candidates: each (query, stratum) asks for ranks pos-k .. pos+k-1 — an equi-join on
   (stratum, rank);
3. exact distances on the candidates, top k per query by a window limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.neighbors import topk_per_group
from tessera.operators.relational import distinct_values, with_prefix_sums

MAX_STRATA = 10000


def knn_strata(ref: DataFrame, queries: DataFrame, k: int, dist, payload: list[str]) -> DataFrame:
    """``ref``: (rid, s, t, *payload); ``queries``: (qid, s, t).
    ``dist(qs, qt, rs, rt)`` → distance Column; ties broken by rid.
    Returns (qid, rid, rank, distance, *payload)."""
    strata = distinct_values(ref, "s", MAX_STRATA)
    qrep = queries.select("qid", F.col("s").alias("qs"), F.col("t").alias("qt"),
                          F.explode(F.array(*[F.lit(v) for v in strata])).alias("s"))
    union = (ref.select("s", "t", F.lit(1).alias("is_ref"), F.col("rid"), F.lit(None).cast("bigint").alias("qid"))
             .unionByName(qrep.select("s", F.col("qt").alias("t"), F.lit(0).alias("is_ref"),
                                      F.lit(None).cast("bigint").alias("rid"), "qid")))
    # ties on t between a query and a reference row: the reference row sorts first
    pre = with_prefix_sums(union, [F.col("s"), F.col("t"), F.desc("is_ref"),
                                   F.coalesce("rid", "qid")], {"c": F.col("is_ref").cast("double")})
    base = pre.groupBy("s").agg(F.min(F.col("c") - F.col("is_ref")).alias("b"))
    pos = pre.join(base, "s").withColumn("before", (F.col("c") - F.col("is_ref") - F.col("b")).cast("bigint"))
    ranked = (pos.where(F.col("is_ref") == 1).select("s", F.col("before").alias("rank"), "rid")
              .join(ref.select("rid", F.col("t").alias("rt"), *payload), "rid"))
    qpos = (pos.where(F.col("is_ref") == 0).select("qid", "s", "before")
            .join(queries.select("qid", F.col("s").alias("qs"), F.col("t").alias("qt")), "qid"))
    cand = qpos.select("qid", "qs", "qt", "s",
                       F.explode(F.sequence(F.greatest(F.col("before") - k, F.lit(0)),
                                            F.col("before") + (k - 1))).alias("rank"))
    pairs = cand.join(ranked, ["s", "rank"])
    scored = pairs.select("qid", "rid", *payload,
                          dist(F.col("qs"), F.col("qt"), F.col("s"), F.col("rt")).alias("distance"))
    return topk_per_group(scored, "qid", [F.round("distance", 12), F.col("rid")], k)
