"""Exact grouped quantiles without gathering a group into one task.

Rows are ordered globally by (group, value, key) with range partitioning (a hot
group spans many partitions), each row gets its global position, and the
quantile positions of each group are looked up by an equi-join on position.
Interpolation is linear between the two closest ranks: pos = (n - 1) * q.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import with_row_index


def grouped_quantiles(df: DataFrame, group: str, value: str, key: str,
                      qs: dict[str, float]) -> DataFrame:
    idx = with_row_index(df.select(group, value, key), [F.col(group), F.col(value), F.col(key)],
                         "_ri")
    stats = idx.groupBy(group).agg(F.min("_ri").alias("_start"), F.count(F.lit(1)).alias("_n"))
    targets = []
    for name, q in qs.items():
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        targets.append(F.struct(F.lit(name).alias("qname"),
                                (F.col("_start") + F.floor(pos)).cast("bigint").alias("lo"),
                                (F.col("_start") + F.ceil(pos)).cast("bigint").alias("hi"),
                                (pos - F.floor(pos)).alias("frac")))
    t = stats.select(group, F.explode(F.array(*targets)).alias("t")).select(group, "t.*")
    lo = idx.select(F.col("_ri").alias("lo"), F.col(value).alias("lo_v"))
    hi = idx.select(F.col("_ri").alias("hi"), F.col(value).alias("hi_v"))
    res = (t.join(lo, "lo").join(hi, "hi")
           .select(group, "qname",
                   (F.col("lo_v") + (F.col("hi_v") - F.col("lo_v")) * F.col("frac")).alias("v")))
    return res.groupBy(group).pivot("qname", list(qs)).agg(F.first("v"))
