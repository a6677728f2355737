"""Baskets reach the blocks of candidates in bounded rounds, and shuffle files go when a step ends."""

import time

import numpy as np
import pytest

from tessera.operators import recommend as RC
from tessera.session import forget, written

ROWS = sorted({(int(u), int(i)) for u, i in np.random.default_rng(5).zipf(1.5, (500, 2)) % (40, 45)}) + [(None, 4), (3, None)]


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_shuffle_files_go_with_the_step(spark):
    before = _shuffle_files(spark)
    t = written(spark.range(1000).repartition(3, "id"), "rows")
    until = time.time() + 20                             # they are removed in the background
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert t.count() == 1000
    forget(t)


@pytest.fixture(scope="module")
def inter(spark):
    return spark.createDataFrame(ROWS, "user bigint, item bigint")


def test_rounds_are_bounded_and_give_the_same(spark, monkeypatch, inter):
    def found():
        best = RC.jaccard_all(inter, k=3).collect()
        return (sorted((r["user"], r["rank"], r["item"], round(r["score"], 9)) for r in RC.item_recommend_all(inter, 3).collect()),
                sorted((r["qitem"], r["item"], r["co"], round(r["sim"], 9)) for r in best))
    one = found()
    sent, send = [], RC._send
    monkeypatch.setattr(RC, "_send", lambda lo, hi, blocks: sent.append((lo, hi, blocks)) or send(lo, hi, blocks))
    for name, value in dict(MET=400, ROUND=1500, HISTORY=60, HISTORIES=2, EXPANDED=50, CELLS=30).items():
        monkeypatch.setattr(RC, name, value)
    assert found() == one and one[0] and one[1]
    met = sum(sum(v == u and i is not None for v, i in ROWS) ** 2 for u in {u for u, _ in ROWS if u is not None})
    assert all(hi - lo == 1 or (hi - lo) * met <= 1500 * blocks for lo, hi, blocks in sent) and any(lo for lo, _, _ in sent)


def test_best_pairs_are_those_of_all_pairs(inter):
    every = {}
    for r in RC.jaccard_all(inter).collect():
        every.setdefault(r["qitem"], []).append((round(r["sim"], 9), r["item"]))
    want = {(q, i) for q, found in every.items() for s, i in found if s >= sorted(found, reverse=True)[:3][-1][0]}
    assert {(r["qitem"], r["item"]) for r in RC.jaccard_all(inter, k=3).collect()} == want
