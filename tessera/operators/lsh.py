"""Random-hyperplane (sign) LSH with multi-probe by Hamming radius.

The hyperplanes are model-sized state (bits × d numbers) drawn from md5 of
"<plane>_<dim>:<seed>", so the same planes are rebuilt by the oracle SQL and
after any failure. Signatures are one projection over the corpus; candidate
search is an equi-join of (query bin XOR mask) with the corpus bin, masks
enumerated up to the search radius — never a theta or cross join.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as V


def plane_value(j: int, i: int, seed: int) -> float:
    h = int(hashlib.md5(f"{j}_{i}:{seed}".encode()).hexdigest()[:8], 16)
    return (h + 0.5) / 4294967296.0 - 0.5


def hyperplanes(n_bits: int, dim: int, seed: int) -> list[list[float]]:
    return [[plane_value(j, i, seed) for i in range(dim)] for j in range(n_bits)]


def planes_sql(n_bits: int, dim: int, seed: int) -> str:
    """DuckDB table (j, p) of the same hyperplanes."""
    return (f"SELECT j, list(((('0x' || substr(md5(j::VARCHAR || '_' || i::VARCHAR || ':{seed}'), 1, 8))"
            f"::BIGINT)::DOUBLE + 0.5) / 4294967296.0 - 0.5 ORDER BY i) AS p "
            f"FROM range(0, {n_bits}) t(j), range(0, {dim}) s(i) GROUP BY j")


def signature(vec, planes: list[list[float]]) -> Column:
    """Integer bin: bit j set when v·plane_j ≥ 0; the first plane is the highest bit."""
    v = F.col(vec) if isinstance(vec, str) else vec
    n = len(planes)
    dots = V.dots_to(v, planes)           # all projections in one batched pass
    weights = F.array(*[F.lit(1 << (n - 1 - j)).cast("bigint") for j in range(n)])
    return F.aggregate(F.zip_with(dots, weights, lambda d, w: F.when(d >= 0, w).otherwise(F.lit(0).cast("bigint"))),
                       F.lit(0).cast("bigint"), lambda acc, b: acc + b)


def hamming_masks(n_bits: int, max_radius: int) -> list[tuple[int, int]]:
    """(mask, radius) for every bit pattern with at most ``max_radius`` bits set."""
    out = []
    for r in range(max_radius + 1):
        for bits in combinations(range(n_bits), r):
            m = 0
            for b in bits:
                m |= 1 << b
            out.append((m, r))
    return out


def probe_bins(queries: DataFrame, qid: str, qbin: str, n_bits: int, max_radius: int) -> DataFrame:
    """(qid, bin, radius) for all bins within ``max_radius`` of each query's bin."""
    masks = F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(r).cast("bigint")
                               .alias("radius")) for m, r in hamming_masks(n_bits, max_radius)])
    return (queries.select(qid, qbin, F.explode(masks).alias("mk"))
            .select(qid, F.col(qbin).bitwiseXOR(F.col("mk.m")).alias("bin"),
                    F.col("mk.radius").alias("radius")))


def candidates(queries: DataFrame, qid: str, qbin: str, corpus: DataFrame, cid: str,
               cbin: str, n_bits: int, max_radius: int) -> DataFrame:
    """(qid, cid, radius): corpus rows whose bin lies within the radius of the query bin."""
    probes = probe_bins(queries, qid, qbin, n_bits, max_radius)
    return probes.join(corpus.withColumnRenamed(cbin, "bin"), "bin").drop("bin")
