"""Word counts and their joins: no entry moves but those of rare words, and the same rows whatever is broadcast."""

import math
from collections import Counter, defaultdict

import pytest

from tessera.operators import sparse_rows as SR
from tessera.operators import text_features as TF
from tessera.session import written

TEXTS = [(1, "a b b c"), (2, "a c d"), (2, "d e"), (3, "A b  f"), (None, "a z"), (4, ""), (5, None), (6, "q q r")]


def docs_of(spark):
    return spark.createDataFrame([(i, t, "xy"[k % 2]) for k, (i, t) in enumerate(TEXTS)], "doc_id bigint, text string, source string")


def counted():
    out = defaultdict(Counter)
    for i, t in TEXTS:
        out[i].update((t or "").lower().split())
    return {(i, w): n for i, c in out.items() for w, n in c.items()}


def test_counting_moves_texts_only(spark):
    counts = TF.word_counts(docs_of(spark), "doc_id")
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1      # before, a second one of all entries
    assert {(r["doc_id"], r["word"]): r["count"] for r in counts.collect()} == counted()


@pytest.mark.parametrize("frequent", [0, 3, 1 << 17])
def test_with_words_whatever_is_broadcast(spark, monkeypatch, frequent):
    monkeypatch.setattr(TF, "FREQUENT", frequent)
    counts = written(TF.word_counts(docs_of(spark), "doc_id"), "counts")
    idf = written(TF.idf_table(counts, len(TEXTS)), "idf")
    assert sum(r["df"] >= TF.frequent_from(idf) for r in idf.collect()) <= frequent
    df = Counter(w for _, w in counted())
    expected = {(i, w): round(n * math.log(len(TEXTS) / df[w]), 9) for (i, w), n in counted().items()}
    assert {(r["doc_id"], r["word"]): round(r["tfidf"], 9) for r in TF.tfidf(counts, idf, "doc_id").collect()} == expected


def test_counts_by_group(spark):
    rows = TF.word_counts_by(docs_of(spark), "doc_id", "source").collect()
    groups = defaultdict(list)
    for k, (i, _) in enumerate(TEXTS):
        groups[i].append("xy"[k % 2])
    assert {(r["doc_id"], r["word"]): r["count"] for r in rows} == counted()
    assert all(r["source"] == sorted(groups[r["doc_id"]]) for r in rows if r["doc_id"] is not None)


@pytest.mark.parametrize("frequent", [0, 1 << 17])
def test_asked_rows_are_the_rows_of_the_asked_words(spark, monkeypatch, frequent):
    """Before, all entries were dealt by word and by document; now only those that a query can meet are rows."""
    monkeypatch.setattr(TF, "FREQUENT", frequent)
    monkeypatch.setattr(SR, "FREQUENT", frequent)
    docs = docs_of(spark)
    queries = spark.createDataFrame([(10, "b", 2), (10, "e", 1), (11, "nowhere", 1), (12, "c", 1)], "id bigint, word string, count bigint")
    counts = written(TF.word_counts(docs, "doc_id"), "counts")
    got, asked = SR.asked_tfidf_rows(counts, len(TEXTS), "doc_id", queries)
    rows, words = SR.tfidf_rows(docs, "doc_id")
    number = {r["word"]: r["number"] for r in words.collect()}
    kept = {number[w] for w in "bec"}

    def entries(df):
        return {(r["id"], c): round(v, 9) for r in df.collect() for c, v in zip(r["cols"], r["vals"])}
    assert entries(got) == {k: v for k, v in entries(rows).items() if k[1] in kept}
    assert {i for i, _ in entries(asked)} == {10, 12}
    plain, plain_asked = SR.asked_count_rows(counts, "doc_id", queries)
    norm = {i: math.sqrt(sum(n * n for (j, _), n in counted().items() if j == i)) for i in (1, 2, 3)}
    assert sorted((i, v) for (i, _), v in entries(plain).items()) == sorted(
        (i, round(n / norm[i], 9)) for (i, w), n in counted().items() if w in "bec" and i is not None)
    assert sorted(v for (i, _), v in entries(plain_asked).items() if i == 10) == [round(1 / math.sqrt(5), 9), round(2 / math.sqrt(5), 9)]
