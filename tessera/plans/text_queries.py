"""Text feature and sparse retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import neighbors as NB
from tessera.operators import packed_search as PS
from tessera.operators import sparse_rows as SR
from tessera.operators import text_features as TF
from tessera.plans.sqlbits import idf_sql, word_counts_sql
from tessera.registry import query
from tessera.session import cut_lineage, written
from tessera.sources.tables import Tables

K_RETRIEVE = 5


def _document_counts(spark, sf_dir):
    return written(TF.word_counts(Tables(spark, sf_dir).documents, "doc_id"), "counts")


def _item_counts(spark, sf_dir):
    return TF.word_counts(Tables(spark, sf_dir).benchmark, "item_id").withColumnRenamed("item_id", "id")


def benchmark_tfidf_neighbours(spark, sf_dir, k=K_RETRIEVE, counts=None):
    """(item_id, doc_id, rank, distance): the documents' words that an item has are packed once, the
    items come in blocks."""
    counts = _document_counts(spark, sf_dir) if counts is None else counts
    rows, queries = SR.asked_tfidf_rows(counts, Tables(spark, sf_dir).documents.count(), "doc_id", _item_counts(spark, sf_dir))
    top, _ = PS.search(SR.pack(rows), queries.persist(), [(0, 0, 0)], k)
    return top.select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), "rank", F.round("distance", 6).alias("distance"))


_TFIDF_COSINE_SQL = f"""
WITH dw AS ({word_counts_sql('documents', 'doc_id')}),
idf AS ({idf_sql('dw', 'documents')}),
dt AS (SELECT doc_id, word, count * idf AS w FROM dw JOIN idf USING (word)),
qw AS ({word_counts_sql('benchmark', 'item_id')}),
qt AS (SELECT item_id, word, count * idf AS w FROM qw JOIN idf USING (word)),
qn AS (SELECT item_id, sqrt(sum(w * w)) AS nrm FROM qt GROUP BY item_id),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM dt GROUP BY doc_id),
dots AS (SELECT item_id, doc_id, sum(qt.w * dt.w) AS dot FROM qt JOIN dt USING (word)
         GROUP BY item_id, doc_id),
sc AS (SELECT item_id, doc_id, 1 - dot / (qn.nrm * dn.nrm) AS dist
       FROM dots JOIN qn USING (item_id) JOIN dn USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(dist, 9), doc_id) AS rk
      FROM sc)
SELECT item_id, doc_id, rk::BIGINT AS rank, round(dist, 6) AS distance FROM r WHERE rk <= {K_RETRIEVE}
"""


@query("tfidf_cosine", oracle=_TFIDF_COSINE_SQL, rows=("J6", "N2", "T1", "T2"))
def tfidf_cosine(spark, sf_dir):
    """Each benchmark item (TF-IDF with the documents' idf) → its 5 nearest documents by cosine."""
    return benchmark_tfidf_neighbours(spark, sf_dir)


# ---------------------------------------------------------------- word-level queries

from tessera.functions import text as TX  # noqa: E402
from tessera.plans.fixtures import (ALL_WORDS_SET, SELECTED_WORDS, STOP_WORDS,  # noqa: E402
                                    words_values_sql)

_PUNCT_SQL = "'[!-/:-@\\[-`{-~]'"


def _word_list(spark, words):
    return F.broadcast(spark.createDataFrame([(w,) for w in words], "word string"))


@query("word_counts", rows=("F1",), oracle=f"""
{word_counts_sql('documents', 'doc_id')}
""")
def word_counts_q(spark, sf_dir):
    """Bag of words of every document, long form (doc_id, word, count)."""
    return TF.word_counts(Tables(spark, sf_dir).documents, "doc_id")


@query("clean_text", rows=("F2",), oracle=f"""
SELECT doc_id, md5(c) AS clean_md5,
       len(list_filter(string_split_regex(c, '[ \\t\\r\\n]+'), lambda x: x <> ''))::BIGINT AS n_words
FROM (SELECT doc_id, regexp_replace(text, {_PUNCT_SQL}, '', 'g') AS c FROM documents)
""")
def clean_text(spark, sf_dir):
    """Remove ASCII punctuation from whole texts; report digest and word count of the result."""
    d = Tables(spark, sf_dir).documents
    c = TX.strip_punctuation("text")
    return d.select("doc_id", F.md5(c).alias("clean_md5"),
                    F.size(TX.tokens(c, lower=False)).cast("bigint").alias("n_words"))


_SEL_COLS_SQL = ",\n  ".join(
    f"coalesce(sum(count) FILTER (WHERE word = '{w}'), 0)::BIGINT AS n_{w}" for w in SELECTED_WORDS)


@query("words_selected", rows=("S4", "F3", "F8", "T6"), oracle=f"""
WITH c AS (SELECT doc_id, regexp_replace(text, {_PUNCT_SQL}, '', 'g') AS text FROM documents),
wc AS ({word_counts_sql('c', 'doc_id', lower=False)}),
sel AS (SELECT * FROM wc JOIN {words_values_sql()} USING (word))
SELECT doc_id,
  {_SEL_COLS_SQL}
FROM documents LEFT JOIN sel USING (doc_id) GROUP BY doc_id
""")
def words_selected(spark, sf_dir):
    """Case-sensitive counts of the listed words after punctuation removal; one column per word,
    0 where absent (dict lookup with default)."""
    docs = Tables(spark, sf_dir).documents
    cleaned = docs.select("doc_id", TX.strip_punctuation("text").alias("text"))
    wc = TF.word_counts(cleaned, "doc_id", lower=False).join(_word_list(spark, SELECTED_WORDS),
                                                             "word")
    wide = wc.groupBy("doc_id").pivot("word", SELECTED_WORDS).agg(F.sum("count"))
    out = docs.select("doc_id").join(wide, "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(F.col(w), F.lit(0)).cast("bigint").alias(f"n_{w}")
                                  for w in SELECTED_WORDS])


@query("doc_length", rows=("F4",), oracle="""
SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_pieces FROM documents
""")
def doc_length(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", TX.length_in_spaces("text").cast("bigint").alias("n_pieces"))


@query("doc_snippet", rows=("F5",), oracle="""
SELECT doc_id, array_to_string(list_slice(list_filter(string_split_regex(text, '[ \\t\\r\\n]+'),
       lambda x: x <> ''), 1, 8), ' ') AS snippet FROM documents
""")
def doc_snippet(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", TX.snippet("text", 8).alias("snippet"))


@query("trim_keys", rows=("F6", "F7"), oracle=f"""
WITH wc AS ({word_counts_sql('documents', 'doc_id')}),
kept AS (SELECT doc_id, sum(count)::BIGINT AS n_kept, count(*)::BIGINT AS n_distinct_kept FROM wc
         WHERE word NOT IN (SELECT word FROM {words_values_sql(STOP_WORDS)}) GROUP BY doc_id),
sel AS (SELECT doc_id, sum(count)::BIGINT AS n_selected FROM wc
        WHERE word IN (SELECT word FROM {words_values_sql()}) GROUP BY doc_id)
SELECT doc_id, coalesce(n_kept, 0)::BIGINT AS n_kept,
       coalesce(n_distinct_kept, 0)::BIGINT AS n_distinct_kept,
       coalesce(n_selected, 0)::BIGINT AS n_selected
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN sel USING (doc_id)
""")
def trim_keys(spark, sf_dir):
    """Drop stop-word keys (anti join) and keep only listed keys (semi join) of each bag of words."""
    docs = Tables(spark, sf_dir).documents
    wc = TF.word_counts(docs, "doc_id")
    kept = (wc.join(_word_list(spark, STOP_WORDS), "word", "left_anti")
            .groupBy("doc_id").agg(F.sum("count").alias("n_kept"),
                                   F.count(F.lit(1)).alias("n_distinct_kept")))
    sel = (wc.join(_word_list(spark, SELECTED_WORDS), "word", "left_semi")
           .groupBy("doc_id").agg(F.sum("count").alias("n_selected")))
    out = docs.select("doc_id").join(kept, "doc_id", "left").join(sel, "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                  for c in ("n_kept", "n_distinct_kept", "n_selected")])


@query("docs_with_all_words", rows=("J5", "F10", "T5"), oracle=f"""
WITH wc AS ({word_counts_sql('documents', 'doc_id')}),
u AS (SELECT doc_id, count(*)::BIGINT AS n_unique FROM wc GROUP BY doc_id),
hit AS (SELECT doc_id FROM wc JOIN {words_values_sql(ALL_WORDS_SET)} USING (word)
        GROUP BY doc_id HAVING count(*) = {len(ALL_WORDS_SET)})
SELECT doc_id, n_unique FROM hit JOIN u USING (doc_id)
""")
def docs_with_all_words(spark, sf_dir):
    """Relational division: documents whose word set contains all listed words, with their
    number of unique words."""
    wc = TF.word_counts(Tables(spark, sf_dir).documents, "doc_id")
    uniq = wc.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_unique"))
    hit = (wc.join(_word_list(spark, ALL_WORDS_SET), "word").groupBy("doc_id")
           .agg(F.count(F.lit(1)).alias("m")).where(F.col("m") == len(ALL_WORDS_SET)))
    return hit.join(uniq, "doc_id").select("doc_id", "n_unique")


@query("doc_top_words", rows=("L6", "F9"), oracle=f"""
WITH wc AS ({word_counts_sql('documents', 'doc_id')})
SELECT doc_id, word, count, rk::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY count DESC, word) AS rk FROM wc)
WHERE rk <= 5
""")
def doc_top_words(spark, sf_dir):
    """Five most common words of every document (dict → rows, then top-k per document)."""
    wc = TF.word_counts(Tables(spark, sf_dir).documents, "doc_id", dealt=False)     # limited before the words are dealt by document
    return NB.topk_per_group(wc, "doc_id", [F.desc("count"), F.col("word")], 5)


_TFIDF_CTES = f"""
dw AS ({word_counts_sql('documents', 'doc_id')}),
idf AS ({idf_sql('dw', 'documents')}),
dt AS (SELECT doc_id, word, count * idf AS tfidf FROM dw JOIN idf USING (word))"""


@query("tfidf", rows=("T1",), oracle=f"""
WITH {_TFIDF_CTES}
SELECT doc_id, word, round(tfidf, 6) AS tfidf FROM dt
""")
def tfidf_q(spark, sf_dir):
    _, _, t = TF.fit_tfidf(Tables(spark, sf_dir).documents, "doc_id")
    return t.select("doc_id", "word", F.round("tfidf", 6).alias("tfidf"))


@query("tfidf_transform", rows=("T2",), oracle=f"""
WITH {_TFIDF_CTES},
qw AS ({word_counts_sql('benchmark', 'item_id')})
SELECT item_id, word, round(count * idf, 6) AS tfidf FROM qw JOIN idf USING (word)
""")
def tfidf_transform(spark, sf_dir):
    """Fit idf on documents, transform the benchmark texts (unseen words drop out)."""
    t = Tables(spark, sf_dir)
    _, idf, _ = TF.fit_tfidf(t.documents, "doc_id")
    q = TF.tfidf(TF.word_counts(t.benchmark, "item_id"), idf, "item_id")
    return q.select("item_id", "word", F.round("tfidf", 6).alias("tfidf"))


@query("tfidf_top_words", rows=("T3",), oracle=f"""
WITH {_TFIDF_CTES}
SELECT doc_id, word, round(tfidf, 6) AS tfidf, rk::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf, 9) DESC, word) AS rk FROM dt)
WHERE rk <= 5
""")
def tfidf_top_words(spark, sf_dir):
    _, _, t = TF.fit_tfidf(Tables(spark, sf_dir).documents, "doc_id")
    top = NB.topk_per_group(t, "doc_id", [F.desc(F.round("tfidf", 9)), F.col("word")], 5)
    return top.select("doc_id", "word", F.round("tfidf", 6).alias("tfidf"), "rank")


@query("join_common_words", rows=("P8", "J1", "T4"), oracle=f"""
WITH nn AS (SELECT item_id, doc_id FROM ({_TFIDF_COSINE_SQL}) WHERE rank = 1),
qw AS ({word_counts_sql('benchmark', 'item_id')}),
dw AS ({word_counts_sql('documents', 'doc_id')})
SELECT nn.item_id, nn.doc_id, qw.word, qw.count AS count_item, dw.count AS count_doc
FROM nn JOIN qw ON qw.item_id = nn.item_id JOIN dw ON dw.doc_id = nn.doc_id AND dw.word = qw.word
""")
def join_common_words(spark, sf_dir):
    """Words shared by each benchmark item and its nearest document, with both counts
    (the clashing ``count`` columns renamed before the join)."""
    t = Tables(spark, sf_dir)
    nn = cut_lineage(benchmark_tfidf_neighbours(spark, sf_dir, 1).select("item_id", "doc_id"))
    qw = TF.word_counts(t.benchmark, "item_id").withColumnsRenamed({"count": "count_item"})
    near = t.documents.select("doc_id", "text").join(nn.select("doc_id").distinct(), "doc_id", "left_semi")
    dw = TF.word_counts(near, "doc_id").withColumnsRenamed({"count": "count_doc"})
    return (nn.join(qw, "item_id").join(dw, ["doc_id", "word"])
            .select("item_id", "doc_id", "word", "count_item", "count_doc"))


@query("knn_enrich", rows=("J2", "J3"), oracle=f"""
SELECT n.item_id, n.doc_id, n.rank, n.distance, d.source, d.lang, d.n_chars
FROM ({_TFIDF_COSINE_SQL}) n JOIN documents d ON n.doc_id = d.doc_id
""")
def knn_enrich(spark, sf_dir):
    """Neighbour ids joined back to their documents' attributes (different key names)."""
    d = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("ref_id"), "source", "lang",
                                               "n_chars")
    n = benchmark_tfidf_neighbours(spark, sf_dir)
    return (n.join(d, n["doc_id"] == d["ref_id"])
            .select("item_id", "doc_id", "rank", "distance", "source", "lang", "n_chars")
            .orderBy("item_id", "rank"))


@query("rank_position", rows=("W6", "N14"), oracle=f"""
WITH dw AS ({word_counts_sql('documents', 'doc_id')}),
qw AS ({word_counts_sql('benchmark', 'item_id')}),
qn AS (SELECT item_id, sqrt(sum(count * count)) AS nrm FROM qw GROUP BY 1),
dn AS (SELECT doc_id, sqrt(sum(count * count)) AS nrm FROM dw GROUP BY 1),
sc AS (SELECT item_id, doc_id, 1 - sum(qw.count * dw.count) / (any_value(qn.nrm) * any_value(dn.nrm)) AS dist
       FROM qw JOIN dw USING (word) JOIN qn USING (item_id) JOIN dn USING (doc_id)
       GROUP BY item_id, doc_id),
nn AS (SELECT item_id, doc_id FROM ({_TFIDF_COSINE_SQL}) WHERE rank = 1),
tgt AS (SELECT nn.item_id, nn.doc_id, round(sc.dist, 9) AS td FROM nn JOIN sc USING (item_id, doc_id))
SELECT tgt.item_id, tgt.doc_id, 0::BIGINT AS pos_tfidf,
       count_if(round(sc.dist, 9) < tgt.td OR (round(sc.dist, 9) = tgt.td AND sc.doc_id < tgt.doc_id))::BIGINT
         AS pos_counts
FROM tgt JOIN sc ON sc.item_id = tgt.item_id GROUP BY tgt.item_id, tgt.doc_id
""")
def rank_position(spark, sf_dir):
    """0-based position of each item's TF-IDF nearest document in its word-count cosine ranking.

    Position = number of candidates ordered before the target; an aggregate, no full sort.
    """
    counts = _document_counts(spark, sf_dir)
    nearest = cut_lineage(benchmark_tfidf_neighbours(spark, sf_dir, 1, counts).select(F.col("item_id").alias("query_id"), F.col("doc_id").alias("id")))
    rows, queries = SR.asked_count_rows(counts, "doc_id", _item_counts(spark, sf_dir))
    found = PS.positions(SR.pack(rows), queries.persist(), nearest)
    return found.select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("pos_tfidf"),
                        F.col("position").alias("pos_counts"))


@query("sparse_triples", rows=("S8", "F23", "F14"), oracle=f"""
WITH {_TFIDF_CTES},
wid AS (SELECT word, (row_number() OVER (ORDER BY word) - 1)::BIGINT AS word_id FROM (SELECT DISTINCT word FROM dt))
SELECT doc_id, word_id, round_even(tfidf, 4) AS value FROM dt JOIN wid USING (word)
""")
def sparse_triples(spark, sf_dir):
    """TF-IDF dict column → (row, word id, value) sparse matrix: dense word ids in word order
    from a distributed row index over the distinct words; values rounded half-to-even."""
    from tessera.operators.relational import with_row_index
    counts, idf, _ = TF.fit_tfidf(Tables(spark, sf_dir).documents, "doc_id")
    words = written(with_row_index(idf, [F.col("word")], "word_id"), "words")
    return TF.with_words(counts, words).select("doc_id", "word_id", F.bround(F.col("count") * F.col("idf"), 4).alias("value"))
