"""TF-IDF rows carry their signature; the vocabulary is hashed in the join, entries are not sorted by word."""

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.hashing import hash32
from tessera.operators import sparse_rows as SR
from tessera.operators import text_features as TF


def test_signature_is_made_with_the_row(spark, monkeypatch):
    monkeypatch.setattr(SR, "BLOCK_ENTRIES", 8)
    rng = np.random.default_rng(7)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 30, 12))) for i in range(60)] + [(60, None), (61, "")], "doc_id bigint, text string")
    rows, words = SR.tfidf_rows(docs, "doc_id", signs=hash32("word", "lsh"), bits=5)
    h = {r["number"]: r["h"] for r in words.select("number", hash32("word", "lsh").alias("h")).collect()}
    plain, _ = SR.tfidf_rows(docs, "doc_id")
    want = {r["id"]: r for r in plain.collect()}
    got = rows.collect()
    assert {r["id"] for r in got} == set(want) and set(want) <= set(range(60))
    for r in got:
        sums = [sum(v if h[c] >> b & 1 else -v for c, v in zip(r["cols"], r["vals"])) for b in range(5)]
        assert int(r["extra"]) == sum(1 << b for b in range(5) if round(sums[b], 9) >= 0)
        assert r["cols"] == want[r["id"]]["cols"] and np.allclose(r["vals"], want[r["id"]]["vals"]) and want[r["id"]]["extra"] == 0


def test_entries_are_not_sorted_by_word(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c{i}") for i in range(20)], "doc_id bigint, text string")
    _, _, t = TF.fit_tfidf(docs, "doc_id")
    plan = t.repartition(2)._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" in plan
    got = {(r["doc_id"], r["word"]): r["tfidf"] for r in t.collect()}
    assert len(got) == 40 and abs(got[(0, "c0")] - np.log(20)) < 1e-12 and t.where(F.col("word") == "a").count() == 0
