"""Positional and relational helpers that stay distributed.

The reference treats row order as meaningful (slices, folds, moving averages).
Here order is always an explicit unique key, and positions are computed
without a single-partition window: the frame is range-partitioned on the key
(hot keys are split by the sampler because the key is unique), sorted within
partitions, materialised once to the shared checkpoint folder, and each
partition's offset comes from a table of per-partition counts (one row per
partition — its size is bounded by the partition count, not by the data).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


FEW = 10_000


def _n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_offsets(df: DataFrame, totals: list, names: list[str]) -> DataFrame:
    """Join each partition's running offsets (``_o_<name>``) of the ``names`` in ``totals``: one
    row per partition, a bound that does not follow the data, so it is broadcast."""
    acc, rows = [0] * len(names), []
    for r in sorted(totals, key=lambda r: r["_pid"]):
        rows.append((r["_pid"], *[float(a) if isinstance(a, float) else a for a in acc]))
        acc = [a + (r[n] or 0) for a, n in zip(acc, names)]
    kinds = ["double" if any(isinstance(r[n], float) for r in totals) else "bigint" for n in names]
    rows = [(r[0], *[float(v) if k == "double" else int(v) for v, k in zip(r[1:], kinds)]) for r in rows]
    schema = "_pid int, " + ", ".join(f"_o_{n} {k}" for n, k in zip(names, kinds))
    offsets = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(offsets), "_pid")


def _ranged(df: DataFrame, order_cols: list) -> DataFrame:
    n = _n_partitions(df)
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_loc", F.monotonically_increasing_id()))
    return cut_lineage(ranged)


def with_row_index(df: DataFrame, order_cols: list, name: str = "row_id",
                   start: int = 0) -> DataFrame:
    """0-based (or ``start``-based) position of each row in the order of ``order_cols``.

    ``order_cols`` must form a unique key, so positions are reproducible.
    """
    ranged = _ranged(df, order_cols)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("c")).collect()
    local = F.col("_loc") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (_with_offsets(ranged, counts, ["c"])
            .withColumn(name, (F.col("_o_c") + local + F.lit(start)).cast("bigint"))
            .select(*df.columns, name))


def ranked(groups: DataFrame, order_cols: list, name: str) -> DataFrame:
    """Rank from 1 of the rows of a grouped table: a table that measures at most ``FEW`` rows is
    ranked in one window, a larger one by ``with_row_index``."""
    groups = groups.persist()
    if groups.count() <= FEW:
        return groups.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)).cast("bigint"))
    return with_row_index(groups, order_cols, name, start=1)


def with_prefix_sums(df: DataFrame, order_cols: list, values: dict[str, Column],
                     index_name: str | None = None) -> DataFrame:
    """Running (inclusive) sums of expressions along a global order, plus optional row index.

    Per-partition running sums are a window *within* a range partition (bounded
    size), then shifted by the totals of the preceding partitions.
    """
    base = df
    for name, expr in values.items():
        base = base.withColumn(f"_v_{name}", expr)
    ranged = _ranged(base, order_cols)
    aggs = [F.count(F.lit(1)).alias("_cnt")] + [F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values]
    totals = ranged.groupBy("_pid").agg(*aggs).collect()
    w = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    out = _with_offsets(ranged, totals, ["_cnt", *[f"_t_{n}" for n in values]])
    for name in values:
        out = out.withColumn(name, F.col(f"_o__t_{name}") + F.sum(f"_v_{name}").over(w))
    if index_name:
        local = F.col("_loc") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
        out = out.withColumn(index_name, (F.col("_o__cnt") + local).cast("bigint"))
    return out.select(*df.columns, *values, *([index_name] if index_name else []))


def rolling_mean(df: DataFrame, order_cols: list, value: str, window: int, name: str,
                 block: int = 1 << 16) -> DataFrame:
    """Mean of ``value`` over the last ``window`` rows in the order of a unique key, full windows
    only. Rows are numbered and dealt into blocks of consecutive positions; each block also gets
    the ``window`` - 1 rows before it, so a window frame stays inside its block and its sum is
    as short as the window itself."""
    block = max(block, window)
    rows = with_row_index(df, order_cols, "_i").withColumn("_b", F.floor(F.col("_i") / block))
    tail = rows.where(F.col("_i") % block > block - window).withColumn("_b", F.col("_b") + 1)
    both = rows.withColumn("_own", F.lit(True)).unionByName(tail.withColumn("_own", F.lit(False)))
    frame = Window.partitionBy("_b").orderBy("_i").rowsBetween(1 - window, 0)
    return (both.withColumn(name, F.avg(value).over(frame))
            .where(F.col("_own") & (F.col("_i") >= window - 1)).select(*df.columns, name))


def onehot_columns(df: DataFrame, col: str, values: list[str], prefix: str | None = None,
                   fill: int = 0) -> list[Column]:
    """One 0/1 column per listed value, named ``prefix_value`` (non-alphanumerics → ``_``);
    nulls → ``fill``."""
    prefix = prefix or col
    return [F.coalesce((F.col(col) == F.lit(v)).cast("bigint"), F.lit(fill))
            .alias(safe_name(f"{prefix}_{v}")) for v in values]


def safe_name(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def distinct_values(df: DataFrame, col: str, max_values: int = 1000) -> list:
    """Distinct values of a categorical column (bounded: refuses above ``max_values``)."""
    rows = df.select(col).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values")
    return sorted(r[0] for r in rows if r[0] is not None)
