"""Rows in boxes: the same nearest rows as a comparison of all pairs, from few of them, and few rows sent on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import block_search
from tessera.operators.boxes import Boxes


@pytest.mark.parametrize(("n", "d"), [(0, 3), (5, 2), (70, 5), (3000, 5), (3000, 2)])
def test_boxes_against_all_pairs(n, d):
    rng = np.random.default_rng(n + d)
    x, q = rng.integers(0, 6, (n, d)).astype(float), rng.integers(0, 6, (40, d)).astype(float)
    q[0, 0] = np.nan
    if n > 10:
        x[3, 0] = np.nan
    ids = np.arange(n)[::-1].copy()
    got = {}
    for who, dist, near, _ in Boxes(x, ids, ids).near(q, np.full(40, np.inf), 15, 1e-9):
        for w, v, i in zip(who.tolist(), dist, near.tolist()):
            got.setdefault(w, []).append((round(v, 9), i))
    for j in range(40):
        all_pairs = sorted((round(float(v), 9), int(i)) for v, i in zip(np.sqrt(((x - q[j]) ** 2).sum(axis=1)), ids) if v == v)
        assert sorted(got.get(j, []))[:15] == all_pairs[:15]


def test_boxes_compare_few_pairs():
    rng = np.random.default_rng(3)
    x, q = rng.random((50_000, 3)), rng.random((500, 3))
    boxes = Boxes(x, np.arange(50_000), np.zeros(50_000, np.int64))
    compared = 0
    compare = boxes._compare

    def counted(who, box, part):
        nonlocal compared
        compared += len(who) * boxes.x.shape[1]
        return compare(who, box, part)
    boxes._compare = counted
    assert sum(len(w) for w, *_ in boxes.near(q, np.full(500, np.inf), 5, 1e-9)) >= 2500
    assert compared < 500 * 50_000 / 20


def test_task_sends_k_rows_of_a_query(spark):
    """Before, every run of rows sent its own k nearest: rows sent grew with queries times rows."""
    rows = spark.range(60_000, numPartitions=2).select(
        F.col("id").alias("row"), F.lit(0).alias("label"), F.array((F.col("id") % 251).cast("double"), F.col("id").cast("double")).alias("vec"))
    queries = spark.range(0, 60_000, 600).select(F.col("id").alias("query_id"), F.array(F.lit(3.0), F.col("id").cast("double")).alias("vec"))
    ids, q = next(block_search._blocks(queries, None))
    shared = spark.sparkContext.broadcast((ids, q))
    sent = rows.mapInArrow(block_search._search(shared, "euclidean", 4, 9), block_search.FOUND)
    assert sent.count() == 2 * 4 * 100


def test_knn_parts_makes_no_candidate_rows(spark, tmp_path):
    """Before, each query and size asked for 30 ranks, each a row of a join."""
    from tessera.plans.similarity_queries import KNN_MAX_K, _knn_parts
    rng = np.random.default_rng(5)
    parts = [(int(i), int(rng.integers(1, 9)), float(rng.integers(900, 2000))) for i in rng.permutation(400)]
    spark.createDataFrame(parts, "p_partkey bigint, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    nn = _knn_parts(spark, str(tmp_path))
    assert "sequence(" not in nn._jdf.queryExecution().toString()
    from tessera.functions.hashing import bucket
    asked = {r[0] for r in spark.range(400).where(bucket("id", 51) >= 800).collect()}
    size, price = {i: s for i, s, _ in parts}, {i: y for i, _, y in parts}
    train = [i for i in size if i not in asked]
    ns, nk = (np.sqrt(sum(v * v for v in values)) for values in ([size[i] for i in train], train))
    got = {}
    for r in nn.collect():
        assert r["y"] == price[r["rid"]] and r["qy"] == price[r["qid"]]
        got.setdefault(r["qid"], []).append((r["rank"], r["rid"]))
    for q in asked:
        near = sorted((round(np.hypot((size[q] - size[i]) / ns, (q - i) / nk), 12), i) for i in train)[:KNN_MAX_K]
        assert [i for _, i in sorted(got[q])] == [i for _, i in near]
