"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import segment_search as ss

SCHEMA = "vec_id bigint, embedding array<float>, label int, number string, vec string, ids string, score string, rank string"


def brute(rows, k, factor=256):
    """Rows are distinct (id, vector) pairs; the score is over the common components."""
    usable = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.add((i, tuple(min(max(math.floor(factor * float(np.float32(x))), ss._MIN), ss._MAX) for x in v)))
    out = []
    for q in usable:
        if q[0] % 50 == 0:
            scores = sorted((-ss.exact(np.array(q[1][:len(c[1])], dtype=object), np.array(c[1][:len(q[1])], dtype=object)), c[0])
                            for c in usable if c != q)
            out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5, **more):
    df = spark.createDataFrame([(i, v, 1, *["junk"] * 5) for i, v in rows], SCHEMA).repartition(4)
    got = ss.search(df, F.col("vec_id") % 50 == 0, k, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(rng, n, d, spread):
    centres = rng.normal(size=(6, d))
    m = centres[rng.integers(6, size=n)] + spread * rng.normal(size=(n, d))
    return m.astype(np.float32).tolist()


@pytest.mark.parametrize("d,spread", [(64, 0.05), (64, 3.0), (9, 0.3), (1, 1.0)])
def test_against_brute_force(spark, d, spread):
    rng = np.random.default_rng(d)
    rows = list(enumerate(clustered(rng, 700, d, spread)))
    assert found(spark, rows) == brute(rows, 5)


def test_blocks_and_small_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = list(enumerate(clustered(rng, 900, 40, 0.1)))
    assert found(spark, rows, block_bytes=40 * 8 * 5) == brute(rows, 5)     # four blocks of queries
    assert found(spark, rows, k=2) == brute(rows, 2)


def test_survivors_at_every_level():
    """Small slices, so that the last place is known early and bounds prune."""
    rng = np.random.default_rng(9)
    whole = np.floor(256 * np.array(clustered(rng, 600, 64, 0.05))).astype(np.int64)
    q = ss.Side(whole[:50])
    best, compared = ss.Best(50, 3), 0
    for lo in range(0, 600, 40):
        x = ss.Side(whole[lo:lo + 40])
        i, j, score = ss.survivors(q, x, best.least, 3)
        compared += len(i)
        best.add(i, score, lo + j, lo + j)
    want = np.sort(whole[:50] @ whole.T, axis=1)[:, ::-1][:, :3]
    assert (best.rows[1].reshape(50, 3) == want).all() and compared < 50 * 600 / 4


def test_statistics_bound_the_score():
    rng = np.random.default_rng(1)
    m = rng.normal(size=(40, 37))
    for s in (1, 4, 16, 37):
        f = ss.statistics(m, s)
        assert (f @ f.T >= m @ m.T - 1e-9).all() and np.allclose((f * f).sum(axis=1), (m * m).sum(axis=1))


def test_edge_cases(spark):
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25, 1.0]
    rows = [(0, None), (50, [1.0, None, 2.0]), (100, [nan, 1.0, 1.0]), (150, [inf, 0.0, 0.0]), (200, []), (250, [0.0, 0.0, 0.0]),
            (None, same), (None, None), (300, same), (350, same), (350, same), (400, [3e38, -3e38, 3e38]), (401, [-3e38, 3e38, 3e38]),
            (450, [1.0]), (500, [1.0, 2.0, 3.0, 4.0, 5.0]), (550, same), (550, [2.0, 2.0, 2.0])]
    rows += [(i, same) for i in range(1000, 1200)] + [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(1200, 1300)]
    rows += rows[-30:]
    assert found(spark, rows) == brute(rows, 5)


def test_few_rows_and_empty_tables(spark):
    assert found(spark, [(50, [1.0, 2.0])]) == []
    assert found(spark, [(50, [1.0, 2.0]), (51, [1.0, -2.0])]) == [(50, 1, 51, -196608)]
    assert found(spark, [(51, [1.0, 2.0])]) == []
    assert found(spark, []) == []
