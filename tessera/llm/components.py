"""Distributed connected components: alternating large-star and small-star rounds.

Every round is two groupings (pre-aggregated minima) and two equi-joins; a hub that holds
a third of all edges is one hot join key, which adaptive execution splits. Links never
reach the driver; it only sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``edges`` → one row (node, component) for each node that has an edge to another one.

    The component is the smallest node reachable. Null ends and loops are ignored; an empty
    table gives an empty result. Direction and repeats don't matter.
    """
    a, b = F.col(src), F.col(dst)
    e = (edges.where(a.isNotNull() & b.isNotNull() & (a != b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = materialise(e, "edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = (both.groupBy("u").agg(F.min("v").alias("m"))
               .select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
        large = e.join(low, "v").select("u", F.col("m").alias("v")).distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u")
        e2 = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
              .unionByName(near.select("u", F.col("m").alias("v"))).distinct())
        last, e = e, materialise(e2, "edges")
        discard(last)
        before, state = state, _state(e)
        if before == state:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
