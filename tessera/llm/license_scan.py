"""Licence scan with a positional rare-token index, in DataFrame functions only.

Licence templates are word sequences with a mandatory key phrase. The index holds, for each
template, the places of its words. Every file is looked up by its highest-IDF licence words
(for each template the key-phrase word with the highest inverse document frequency, counted
over all files): a hit at position p of a word at place q of the template proposes that the
template starts at word p - q. The postings of the other words are intersected at the same
relative position, and a proposal stands if all words of the key phrase are there.

The template index is fixed and small (broadcast); a file only contributes rows for its
licence words, and only if it holds a looked-up word at all.

Defined results: null and empty texts have no words; a label is listed once however often
it occurs; files without a match have empty labels, null positions and score 0; repeated
rows each get theirs; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.url_filter import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str            # words separated by blanks
    key: str             # mandatory phrase, part of ``text``
    base: bool = False   # a phrase of the base scan

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        w, k = self.words, self.key.split()
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)

    @property
    def key_words(self) -> list[str]:
        return self.key.split()


TEMPLATES = [
    Template("mit", "mit license", "mit license", base=True),
    Template("apache", "apache license", "apache license", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache software license version 2 0", "apache software license"),
    Template("lgpl", "gnu lesser general public license version", "lesser general public license"),
    Template("agpl", "gnu affero general public license version", "affero general public license"),
    Template("gpl-3", "gnu general public license version 3", "general public license version 3"),
    Template("gpl-2", "gnu general public license version 2", "general public license version 2"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("bsd", "licensed under the bsd license", "bsd license"),
    Template("mpl", "mozilla public license version 2 0", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             "permission to use copy modify and or distribute this software"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international", "creative commons attribution sharealike"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def idf(docs: DataFrame, text: str, templates: list[Template]) -> dict[str, float]:
    """Inverse document frequency of each template word over all files: one row per word."""
    vocabulary = _vocabulary(templates)
    found = docs.select(words_of(F.col(text)).alias("_w"))
    found = found.select(F.explode(F.array_append(F.array_intersect("_w", F.array(*map(F.lit, vocabulary))), F.lit(""))).alias("word"))
    df = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: math.log((df.get("", 0) + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in vocabulary}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         templates: list[Template] | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, matches): one row per file (row, doc_id, n_words), and one per place of a
    template (row, label, base, start, end, score)."""
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    weight = idf(docs, text, templates)
    rare = [max(t.key_words, key=lambda w: (weight[w], w)) for t in templates]
    looked_up, vocabulary = sorted(set(rare)), _vocabulary(templates)
    words = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("_w"))
    places = F.transform("_w", lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    files = words.select(
        "doc_id", F.size("_w").cast("bigint").alias("n_words"),
        F.when(F.arrays_overlap("_w", F.array(*map(F.lit, looked_up))),
               F.filter(places, lambda x: x["word"].isin(vocabulary))).alias("_hits"))
    # the row number names the file from here on: written once, it can't change
    files = materialise(files.withColumn("row", F.monotonically_increasing_id()), "files")
    index = [(i, w, q, weight[w], t.key_at <= q < t.key_at + len(t.key_words))
             for i, t in enumerate(templates) for q, w in enumerate(t.words)]
    index = spark.createDataFrame(index, "t int, word string, place int, weight double, key boolean")
    anchors = spark.createDataFrame([(i, w, t.key_at + t.key_words.index(w)) for i, (t, w) in enumerate(zip(templates, rare, strict=True))],
                                    "t int, word string, place int")
    about = spark.createDataFrame([(i, t.label, t.base, len(t.words), len(t.key_words), sum(weight[w] for w in t.words), t.key_at)
                                   for i, t in enumerate(templates)],
                                  "t int, label string, base boolean, size int, key_size int, total double, key_at int")
    hits = files.where("_hits is not null").select("row", F.inline("_hits"))
    # the templates are fixed: a few hundred rows at most
    proposed = hits.join(F.broadcast(anchors), "word").select("row", "t", (F.col("pos") - F.col("place")).alias("start"))
    aligned = (hits.join(F.broadcast(index), "word")
               .select("row", "t", (F.col("pos") - F.col("place")).alias("start"), "weight", "key"))
    matches = (aligned.groupBy("row", "t", "start")
               .agg(F.sum("weight").alias("weight"), F.sum(F.col("key").cast("int")).alias("keys"))
               .join(proposed, ["row", "t", "start"], "left_semi")
               .join(F.broadcast(about), "t").where("keys = key_size")
               .select("row", "label", "base", (F.col("start") + F.col("key_at")).cast("bigint").alias("start"),
                       (F.col("start") + F.col("key_at") + F.col("key_size")).cast("bigint").alias("end"),
                       F.least(F.lit(1.0), F.round(F.col("weight") / F.col("total"), 6)).alias("score")))
    return files.select("row", "doc_id", "n_words"), matches


def label_files(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                templates: list[Template] | None = None) -> DataFrame:
    """One row per file: doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    (sorted lists) and score (the best share of a matched template's IDF weight)."""
    files, matches = scan(docs, doc_id, text, templates)
    start = F.when(F.col("base"), F.col("start"))
    per_file = matches.groupBy("row").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"), F.max("score").alias("score"))
    none = F.expr("cast(array() as array<string>)")
    return files.join(per_file, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
