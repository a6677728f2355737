"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Each stage works on all that the one before it kept. All but the last return the columns of
``documents``; the last one returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, jaccard_join, quality, suffix_dedup
from tessera.llm.common import scratch_path
from tessera.llm.queries import quality_model, vocabulary_path
from tessera.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A missing text is judged as an empty one, equal
    rows alike, rows without id too (they are never learned from); without labels all documents have
    score 0.5 and stay; an empty table stays empty. Other columns are handed through."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, carry=tuple(docs.columns))
    return scored.where(F.col("score") >= quality.SCORE_BOUND).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id. Texts without a
    word (missing, empty) link with nothing and all stay; repeated rows are one document; in a group
    without any id one row of each set of shingles stays."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has; characters that
    a cut divides go, and n_chars follows the text. A document may become empty; a missing
    text becomes an empty one."""
    out = suffix_dedup.remove_repeats(docs, carry=tuple(docs.columns), as_text=True)

    def column(name: str):
        if name == "text":
            return F.col("kept")
        if name == "n_chars":
            return F.length("kept").cast(docs.schema[name].dataType)
        return F.col("row").getField(name)
    return out.select(*(column(c).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage. Texts without a word are never hit; equal rows are
    judged alike, rows without id too; an empty benchmark hits nothing."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    return found.where(F.size("hit_words") == 0).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (binary: little-endian unsigned 32-bit), their number and
    digest, and the digest of the text that decoding them gives. A missing or empty text has no
    tokens; every row has its row, with the id it has."""
    vocabulary = bpe.share(docs, vocabulary_path())
    out = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats),
          ("decontamination", drop_contaminated), ("tokens", tokens)]

#: The stages hold a trained classifier, a hashed search and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
