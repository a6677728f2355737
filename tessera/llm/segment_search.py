"""Exact search of the greatest inner products by multi-resolution segment statistics.

Vectors become whole numbers. For two vectors q and x, the squared distance is
|q|^2 + |x|^2 - 2 score, and cutting both into segments bounds it from below:
sum over segments of width * ((mean q - mean x)^2 + (dev q - dev x)^2). Since a vector's own
width * (mean^2 + dev^2) add up to its squared length, that bound says exactly
score <= f(q) . f(x), where f lists sqrt(width) * mean and sqrt(width) * dev of each segment.
A query visits the rows with few wide segments first, then with more and narrower ones; a row
whose lower-bound distance is already beyond the query's last place drops out. Exact scores
are computed for the survivors only, in whole numbers.

Equal vectors are one class with its smallest ids (one more than asked for, so that a query
may itself be among them), so a vector that many rows repeat is compared once. The distinct
query vectors come in blocks of bounded bytes; each block is broadcast, meets all classes, and
every task sends on its best rows alone. No pair of vectors becomes a row.

Defined results: vectors that are null or hold null or non-finite components, and rows without
an id, take no part; of vectors of different lengths the shorter one counts as filled up with
zeros, an empty one scores 0 with all; rows that repeat both id and vector count once; an id
with several vectors is a query and a candidate with each of them, and only the query's own
row is left out. Scaled components and scores end at the 64-bit range. An empty table, or one
without queries, gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, give_back, materialise, ranges, scratch_path

LEVELS = (4, 16)            # segments, coarse to fine
BLOCK_BYTES = 8 << 20       # of query components in a broadcast block, about
QUERIES, ROWS = 1024, 2048  # compared at a time in a task
DENSE_SHARE = 0.2           # survivors up to which pairs are handled one by one
_MIN, _MAX = -(1 << 63), (1 << 63) - 1


def scaled(vector: str, factor: float) -> Column:
    """floor(factor * x) of each component x (as double); null where the vector takes no part."""
    v = F.col(vector)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(v, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("bigint")))


def statistics(m: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(width) * mean and sqrt(width) * deviation of each segment of each row."""
    edges = np.linspace(0, m.shape[1], segments + 1).astype(np.int64)
    width = np.diff(edges)
    total = np.add.reduceat(m, edges[:-1], axis=1)
    square = np.add.reduceat(m * m, edges[:-1], axis=1)
    mean = total / width
    dev = np.sqrt(np.maximum(square / width - mean * mean, 0))
    return np.hstack([mean, dev]) * np.sqrt(np.concatenate([width, width]))


class Side:
    """Some vectors of equal length with their statistics at each level."""

    def __init__(self, whole: np.ndarray):
        self.whole = whole
        self.m = whole.astype(np.float64)
        self.norm = np.sqrt((self.m * self.m).sum(axis=1))
        self.levels = [statistics(self.m, s) for s in LEVELS if 2 * s < whole.shape[1]]


def exact(q: np.ndarray, x: np.ndarray) -> int:
    return min(max(sum(a * b for a, b in zip(q.tolist(), x.tolist())), _MIN), _MAX)


def survivors(q: Side, x: Side, least: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, row, score) that can be among the ``keep`` best rows of their query, whose
    last place so far is ``least``: all rows of score >= the last place among both."""
    # bounds and products in double precision: slack for what rounding can take away
    slack = 1e-9 * q.norm[:, None] * x.norm.max(initial=0) + 1e-6
    floor = least[:, None].astype(np.float64) - slack
    i = j = None
    for fq, fx in zip(q.levels, x.levels):
        if i is None:
            alive = fq @ fx.T >= floor
            if alive.mean() <= DENSE_SHARE:
                i, j = np.nonzero(alive)
        else:
            ok = np.einsum("ij,ij->i", fq[i], fx[j]) >= floor[i, 0]
            i, j = i[ok], j[ok]
    wide = q.norm.max(initial=0) * x.norm.max(initial=0) >= 2.0 ** 52
    if i is None and not wide:
        score = q.m @ x.m.T
        n = score.shape[1]
        if n > keep:
            least = np.maximum(least, np.partition(score, n - keep, axis=1)[:, n - keep].astype(np.int64))
        i, j = np.nonzero(score >= least[:, None])
        return i, j, score[i, j].astype(np.int64)
    if i is None:
        i, j = (a.ravel() for a in np.indices((len(q.m), len(x.m))))
    if wide:
        score = np.array([exact(q.whole[a], x.whole[b]) for a, b in zip(i, j)], dtype=np.int64)
    else:
        score = np.einsum("ij,ij->i", q.m[i], x.m[j]).astype(np.int64)
    ok = score >= least[i]
    return i[ok], j[ok], score[ok]


class Best:
    """The best rows of each query so far: greatest score first, then smallest id."""

    def __init__(self, queries: int, keep: int):
        self.keep = keep
        self.least = np.full(queries, _MIN, dtype=np.int64)
        self.rows = [np.zeros(0, dtype=np.int64)] * 4       # query, score, id, class

    def add(self, *new: np.ndarray) -> None:
        q, score, vec_id, number = (np.concatenate([a, b]) for a, b in zip(self.rows, new))
        order = np.lexsort((number, vec_id, ~score, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        order, q, place = order[place < self.keep], q[place < self.keep], place[place < self.keep]
        self.rows = [q, score[order], vec_id[order], number[order]]
        full = place == self.keep - 1
        self.least[q[full]] = self.rows[1][full]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and the start of each row's list (n + 1)."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(), at - at[0]


def _search(shared, keep: int):
    def run(batches):
        numbers, flat, starts = shared.value
        lens = np.diff(starts)
        by_length: dict[int, list[Side]] = {}
        asked = [np.arange(a, min(a + QUERIES, len(numbers))) for a in range(0, len(numbers), QUERIES)]
        best = [Best(len(a), keep) for a in asked]
        longest = int(lens.max(initial=0))

        def sides(length: int) -> list[Side]:
            """The queries cut to a length that rows have, or filled up to it."""
            width = min(length, longest)
            if width not in by_length:
                whole = np.zeros((len(numbers), width), dtype=np.int64)
                n = np.minimum(lens, width)
                at = ranges(np.zeros(len(n), dtype=np.int64), n)
                whole[np.repeat(np.arange(len(n)), n), at] = flat[np.repeat(starts[:-1], n) + at]
                by_length[width] = [Side(whole[a]) for a in asked]
            return by_length[width]

        for batch in batches:
            number = batch.column("number").to_numpy()
            vec, at = _lists(batch.column("vec"))
            ids, id_at = _lists(batch.column("ids"))
            size = np.diff(at)
            for length in np.unique(size).tolist():
                mine = np.flatnonzero(size == length)
                for lo in range(0, len(mine), ROWS):
                    rows = mine[lo:lo + ROWS]
                    x = Side(vec[at[rows][:, None] + np.arange(min(length, longest))])
                    for q, top in zip(sides(length), best):
                        i, j, score = survivors(q, x, top.least, keep)
                        if len(i):
                            n = np.diff(id_at)[rows[j]]
                            top.add(np.repeat(i, n), np.repeat(score, n), ids[ranges(id_at[rows[j]], n)],
                                    np.repeat(number[rows[j]], n))
        for a, top in zip(asked, best):
            q, score, vec_id, mine = top.rows
            if len(q):
                yield pa.RecordBatch.from_arrays([pa.array(numbers[a[q]]), pa.array(vec_id), pa.array(mine), pa.array(score)],
                                                 ["number", "vec_id", "of", "score"])
        give_back()
    return run


FOUND = "number bigint, vec_id bigint, of bigint, score bigint"


def search(vectors: DataFrame, is_query: Column, k: int, factor: float = 256, vec_id: str = "vec_id",
           embedding: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of ``vectors`` with the greatest
    inner products with each query row, ties to the smaller id. ``is_query`` tells the query
    rows by the column ``vec_id``."""
    spark = vectors.sparkSession
    rows = (vectors.select(vectors[f"`{vec_id}`"].cast("bigint").alias("vec_id"), vectors[f"`{embedding}`"].alias("embedding"))
            .select("vec_id", scaled("embedding", factor).alias("vec")).where("vec_id is not null and vec is not null").distinct())
    smallest = Window.partitionBy("vec").orderBy("vec_id")
    classes = (rows.withColumn("_place", F.row_number().over(smallest)).where(F.col("_place") <= k + 1)
               .groupBy("vec").agg(F.collect_list("vec_id").alias("ids")))
    classes = materialise(classes.withColumn("number", F.monotonically_increasing_id()), "classes")
    asked = materialise(rows.where(is_query).join(classes.select("vec", "number"), "vec").select("vec_id", "number"), "asked")
    queries = classes.join(asked.select("number").distinct(), "number", "left_semi").select("number", "vec")
    n, longest = queries.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    blocks = max(1, -(-n * (longest or 0) * 8 // block_bytes))
    found_path = scratch_path(spark, "found")
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).toArrow().combine_chunks()
        if block.num_rows:
            flat, starts = _lists(block.column("vec").combine_chunks())
            shared = spark.sparkContext.broadcast((block.column("number").to_numpy(), flat, starts))
            near = classes.select("number", "vec", "ids").mapInArrow(_search(shared, k + 1), FOUND)
            order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id", "of")
            near = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k + 1).drop("_place")
            near.write.mode("append").parquet(found_path)
            shared.destroy()
    if n == 0:
        spark.createDataFrame([], FOUND).write.parquet(found_path)
    discard(classes)
    found = spark.read.schema(FOUND).parquet(found_path)
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(found, "number")
    pairs = pairs.where((F.col("query_id") != F.col("vec_id")) | (F.col("number") != F.col("of")))
    order = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id", "of")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
