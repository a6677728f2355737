"""Deterministic hash splits, folds, class balancing and sampling.

All randomness is a salted md5 of the row key (see functions.hashing), so a
split is a pure function of the row: reproducible after executor loss, equal
in the DuckDB oracle, and computed in one narrow projection (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import bucket, hash32, uniform
from tessera.operators.relational import with_row_index


def hash_split(df: DataFrame, key: str, fraction: float, seed: int,
               names=("train", "test"), col: str = "split") -> DataFrame:
    thr = int(round(fraction * 1000))
    return df.withColumn(col, F.when(bucket(key, seed) < thr, F.lit(names[0]))
                         .otherwise(F.lit(names[1])))


def hash_split_nested(df: DataFrame, key: str, fractions: list[float], seed: int,
                      names: list[str], col: str = "split") -> DataFrame:
    """Successive splits: piece i takes ``fractions[i]`` of what remains (salt seed+i)."""
    expr = F.lit(names[-1])
    for i in reversed(range(len(fractions))):
        thr = int(round(fractions[i] * 1000))
        expr = F.when(bucket(key, seed + i) < thr, F.lit(names[i])).otherwise(expr)
    return df.withColumn(col, expr)


def shuffle_position(df: DataFrame, key: str, seed: int, name: str = "pos") -> DataFrame:
    """Seeded shuffle: 0-based position in the order (hash(key, seed), key)."""
    return with_row_index(df.withColumn("_h", hash32(key, seed)), [F.col("_h"), F.col(key)],
                          name).drop("_h")


def kfold_assign(df: DataFrame, key: str, k: int, seed: int, n: int | None = None) -> DataFrame:
    """Fold of each row: fold i holds positions floor(n*i/k) .. floor(n*(i+1)/k)-1."""
    n = n if n is not None else df.count()
    pos = shuffle_position(df, key, seed)
    return pos.withColumn("fold", F.floor((F.col("pos") * k + (k - 1)) / F.lit(n)).cast("bigint"))


def undersample_majority(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Keep each row of the largest class with probability n_min / n_maj (n_min: the smallest
    class) and all rows of the others; with a single class, everything. Rows without a label
    are no class and stay."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    ends = counts.agg(F.min("c").alias("n_min"), F.max(F.struct("c", F.col(label).alias("v"))).alias("top")).first()
    if ends["n_min"] is None or ends["n_min"] == ends["top"]["c"]:
        return df
    ratio = ends["n_min"] / ends["top"]["c"]
    return df.where(F.coalesce(F.col(label) != F.lit(ends["top"]["v"]), F.lit(True)) | (uniform(key, seed) < F.lit(ratio)))


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement: the n smallest salted hashes (top-k, one pass)."""
    return (df.withColumn("_h", hash32(key, seed)).orderBy("_h", key).limit(n).drop("_h"))
