"""Bag-of-words and TF-IDF in long (id, word, value) form.

The long form is the distributed sparse matrix: joins and aggregations on
``word`` replace the reference's in-memory dicts and CSR matrices. A document's
words never leave its rows; no per-document collection into one task.

Texts are dealt by document before they are split, so that counting moves no words. Joins with a
vocabulary broadcast its most frequent words (at most ``FREQUENT``, which most entries hold) and
move only the entries of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import WHITESPACE
from tessera.session import written
from tessera.sources.tables import spread

FREQUENT = 1 << 17      # words of a vocabulary that are broadcast, at most


def word_counts(docs: DataFrame, id_col: str, text_col: str = "text",
                lower: bool = True, dealt: bool = True) -> DataFrame:
    """(id, word, count) for every word of every text (whole texts, no prefix). Texts are dealt by
    document first, or (``dealt`` False) counted where they are and then dealt by document and word."""
    t = F.lower(F.col(text_col)) if lower else F.col(text_col)
    texts = docs.select(id_col, text_col)
    return ((texts.repartition(id_col) if dealt else spread(texts))
            .select(id_col, F.explode(F.split(t, WHITESPACE)).alias("word"))
            .where(F.col("word") != "")          # empty pieces dropped after the explode (compiled)
            .groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("count")))


def word_counts_by(docs: DataFrame, id_col: str, group: str, text_col: str = "text") -> DataFrame:
    """(id, word, count, groups): ``word_counts`` with the sorted list of the groups of the id's rows (usually
    one), in a column named as ``group``. It is joined where the words are counted: no entry moves."""
    groups = (docs.select(id_col, group).repartition(id_col).groupBy(id_col)
              .agg(F.sort_array(F.collect_list(group)).alias(group)))
    return word_counts(docs, id_col, text_col).join(groups.hint("shuffle_hash"), id_col, "left")


def idf_table(counts: DataFrame, n_docs: int, df: Column | None = None) -> DataFrame:
    """(word, df, idf) with idf = ln(N / df), unsmoothed. Words in every document (idf 0) are
    kept out: their TF-IDF weight is exactly zero, and they are the hottest join keys.

    ``n_docs`` (corpus size) is one scalar on the driver (a metadata count); ``df`` adds up counted entries.
    """
    df = counts.groupBy("word").agg((F.count(F.lit(1)) if df is None else df).alias("df"))
    return (df.where(F.col("df") < F.lit(n_docs))
            .select("word", "df", F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf")))


def frequent_from(words: DataFrame) -> int:
    """The least power of two so that at most ``FREQUENT`` words of a table (word, df, ...) have that df
    or more. One row per power of two is all that reaches the driver."""
    sizes = words.groupBy((F.length(F.bin("df")) - 1).alias("power")).count().collect()
    least, n = 64, 0
    for power, size in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        n += size
        if n > FREQUENT:
            break
        least = power
    return 1 << min(least, 62)


def with_words(counts: DataFrame, words: DataFrame) -> DataFrame:
    """Entries (id, word, count) joined with a vocabulary (word, df, ...), both read twice: tables that are written."""
    least = frequent_from(words)
    frequent, rare = words.where(F.col("df") >= least).drop("df"), words.where(F.col("df") < least).drop("df")
    near = counts.join(F.broadcast(frequent), "word")
    # the vocabulary's part is hashed: sorting the entries by word would be most of the work
    far = counts.join(F.broadcast(frequent.select("word")), "word", "left_anti").join(rare.hint("shuffle_hash"), "word")
    return near.unionByName(far)


def tfidf(counts: DataFrame, idf: DataFrame, id_col: str) -> DataFrame:
    """(id, word, tfidf) = count · idf. Words without an idf (unseen in the fit corpus) drop out."""
    return (with_words(counts, idf)
            .select(id_col, "word", (F.col("count") * F.col("idf")).alias("tfidf")))


def fit_tfidf(docs: DataFrame, id_col: str, text_col: str = "text"):
    """Returns (counts, idf, tfidf) for a corpus.

    The bag-of-words table feeds several branches (document frequencies, weights, norms,
    the inverted-index join); it and the idf are written once to the shared folder so
    the texts are scanned and tokenised once per query, not once per branch."""
    counts = written(word_counts(docs, id_col, text_col), "counts")
    idf = written(idf_table(counts, docs.count()), "idf")
    return counts, idf, tfidf(counts, idf, id_col)
