"""Language identification by string kernels.

A text is the set of its byte n-grams (n = 2, 3, 4; A-Z lower-cased, bytes other than letters
as blanks). Nyström landmarks (a few texts per language) map a text to its kernel values with
them, and one-versus-rest kernel ridge regression over this map gives a value per language. The
n-grams of the landmarks have numbers of their own (a trie of three levels, as large as the
landmarks), so the blended-spectrum presence kernel of a text and a landmark is exactly the
number of n-grams they share, whatever the text's length; it is normalised by the landmark's
n-grams and the text's n-grams that any landmark has. Everything is a product of a 0/1 matrix
of documents with the landmarks' matrix.

All labelled texts are learned from: each task sums K'K and K'1 per language, the sums meet in
a tree, and the driver solves a system of the landmarks' size. Each language has weight 1.

Defined results: ``und`` with score 0 for null texts and texts without a letter; a text without a
language is not learned from (an empty string is a language); with nothing to learn every text is
``und``; a text that shares no n-gram with a landmark goes, like equal values, to the language
first in order; repeated rows each get their row, and count once among the landmarks.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Texts, small

LANDMARKS = 96           # about; shared out among the languages, one each at least
RIDGE = 1e-3
CELLS = 1 << 22          # of one matrix of documents and n-grams, about

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


# symbols: letters and the blank, and all bytes over 127
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[32, *range(97, 123), *range(128, 256)]] = np.arange(155)
SYMBOLS = 155


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 2, 3, 4: symbol codes of all n-grams that lie in one document, and the document."""
    sym = _SYMBOL[_FOLD[data]]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out, code = [], sym
    for n in (2, 3, 4):
        code = code[:max(len(sym) - n + 1, 0)] * SYMBOLS + sym[n - 1:] if len(sym) >= n else code[:0]
        inside = doc[n - 1:] == doc[:len(code)] if len(code) else np.zeros(0, dtype=bool)
        out.append((code[inside], doc[:len(code)][inside]))
    return out


class Grams:
    """Numbers of the n-grams of some texts: tables from a symbol pair, and from the number of an
    n-gram and the next symbol, to a number (0: not among them; numbers count through all n)."""

    def __init__(self, codes: list[np.ndarray]):
        """``codes``: the distinct n-grams for n = 2, 3, 4."""
        self.codes = [np.unique(c) for c in codes]
        self.base = np.concatenate([[0], np.cumsum([len(c) for c in self.codes])])
        self.size = int(self.base[-1])
        self.tables = [np.zeros(SYMBOLS * SYMBOLS, dtype=np.int32)]
        self.tables[0][self.codes[0]] = 1 + np.arange(len(self.codes[0]))
        for level in (1, 2):
            before = self.number(level - 1, self.codes[level] // SYMBOLS)
            table = np.zeros((len(self.codes[level - 1]) + 1) * SYMBOLS, dtype=np.int32)
            table[before * SYMBOLS + self.codes[level] % SYMBOLS] = 1 + np.arange(len(self.codes[level]))
            self.tables.append(table)

    def number(self, level: int, code: np.ndarray) -> np.ndarray:
        return (np.searchsorted(self.codes[level], code) + 1).astype(np.int64)

    def presence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """0/1 matrix (documents, size): which of the n-grams each document has."""
        docs = len(offsets) - 1
        out = np.zeros((docs, self.size), dtype=np.float32)
        sym = _SYMBOL[_FOLD[data]]
        doc = np.repeat(np.arange(docs), np.diff(offsets))
        slot = sym
        for level, n in enumerate((2, 3, 4)):
            if len(sym) < n:
                break
            slot = self.tables[level][slot[:len(sym) - n + 1] * SYMBOLS + sym[n - 1:]].astype(np.int64)
            hit = np.flatnonzero((slot > 0) & (doc[n - 1:] == doc[:len(slot)]))
            out[doc[hit], self.base[level] + slot[hit] - 1] = 1
        return out


def _blocks(texts: Texts, grams: Grams):
    step = max(1, CELLS // max(grams.size, 1))
    for i, j in texts.slices():
        for k in range(i, j, step):
            yield k, min(k + step, j), grams.presence(*texts.part(k, min(k + step, j)))


def _kernel(p: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel values with the (normalised) landmarks."""
    return (p @ landmarks) / np.sqrt(np.maximum(p.sum(axis=1), 1))[:, None]


def _gram_rows(batches):
    """Distinct n-gram codes of each text, by n."""
    for batch in small(batches):
        texts = Texts(batch.column("text"))
        sets = [[] for _ in range(3)]
        for i, j in texts.slices():
            for level, (code, doc) in enumerate(gram_codes(*texts.part(i, j))):
                both = np.unique(doc * SYMBOLS ** 4 + code)
                at = np.searchsorted(both // SYMBOLS ** 4, np.arange(j - i + 1))
                sets[level] += [(both[a:b] % SYMBOLS ** 4).tobytes() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in sets], ["two", "three", "four"])


def _moments(shared, langs: list[str]):
    """Per task and language: count, K'1 and K'K of its texts, as one array of doubles."""
    def run(batches):
        grams, landmarks = shared.value
        number = {x: i for i, x in enumerate(langs)}
        sums: dict[int, np.ndarray] = {}
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            lang = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()])
            for i, j, p in _blocks(texts, grams):
                k = _kernel(p, landmarks).astype(np.float64)
                for c in np.unique(lang[i:j]):
                    if c >= 0:
                        own = k[lang[i:j] == c]
                        got = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                        sums[c] = sums[c] + got if c in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c) for c in sums], type=pa.int32()), pa.array([s.tobytes() for s in sums.values()], type=pa.binary())],
                ["part", "sums"])
    return run


def sum_arrays(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the double arrays ``sums`` by ``part``: in tasks first, about the square root
    of their number, then on the driver."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, s in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                x = np.frombuffer(s, dtype=np.float64)
                total[c] = total[c] + x if c in total else x.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), type=pa.int32()),
                                              pa.array([s.tobytes() for s in total.values()], type=pa.binary())], ["part", "sums"])

    tasks = max(1, math.isqrt(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out: dict[int, np.ndarray] = {}
    for r in parts.repartition(tasks).mapInArrow(add, "part int, sums binary").toLocalIterator():
        x = np.frombuffer(bytes(r["sums"]), dtype=np.float64)
        out[r["part"]] = out[r["part"]] + x if r["part"] in out else x
    return out


class KernelModel:
    """Languages, the numbered n-grams, the landmarks' matrix (n-grams, m) and coefficients (m, languages)."""

    def __init__(self, langs: list[str], grams: Grams, landmarks: np.ndarray, weights: np.ndarray):
        self.langs, self.grams, self.landmarks, self.weights = langs, grams, landmarks, weights

    def values(self, p: np.ndarray) -> np.ndarray:
        return _kernel(p, self.landmarks) @ self.weights


def landmark_matrix(sets: list[list[np.ndarray]]) -> tuple[Grams, np.ndarray]:
    """Numbered n-grams of the landmarks (per landmark: distinct codes for n = 2, 3, 4) and the 0/1
    matrix (n-grams, landmarks), each column scaled to unit norm; equal landmarks count once."""
    grams = Grams([np.concatenate([s[level] for s in sets]) if sets else np.zeros(0, dtype=np.int64) for level in range(3)])
    marks = np.zeros((len(sets), grams.size), dtype=np.float32)
    for r, s in enumerate(sets):
        for level in range(3):
            marks[r, grams.base[level] + grams.number(level, s[level]) - 1] = 1
    marks = np.unique(marks, axis=0) if len(marks) else marks
    return grams, (marks / np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1))).T.copy()


def solve(marks: np.ndarray, sums: dict[int, np.ndarray], langs: int) -> np.ndarray:
    """Ridge coefficients (m, languages) from each language's count, K'1 and K'K; languages weigh the same."""
    m = marks.shape[1]
    gram, target = np.zeros((m, m)), np.zeros((m, langs))
    for c, s in sums.items():
        gram += s[1 + m:].reshape(m, m) / s[0]
        for other in range(langs):
            target[:, other] += (1 if other == c else -1 / max(1, langs - 1)) * s[1:1 + m] / s[0]
    inner = (marks.T @ marks).astype(np.float64)
    return np.linalg.solve(gram + RIDGE * inner + 1e-8 * np.eye(m), target)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        landmarks: int = LANDMARKS) -> KernelModel:
    """Learn from all rows of ``docs`` with a text and a language."""
    spark = docs.sparkSession
    rows = (docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}")))
    # one row per language: bounded by the number of languages
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().toLocalIterator())
    if not langs:
        return KernelModel([], Grams([np.zeros(0, dtype=np.int64)] * 3), np.zeros((0, 0), dtype=np.float32), np.zeros((0, 0)))
    each = max(1, landmarks // len(langs))
    # hash order of the ids; among texts of one id the order of a hash of the text
    key = [F.xxhash64("id", F.lit(6)).alias("h"), F.xxhash64("text").alias("t")]
    order = Window.partitionBy("lang").orderBy("h", "id", "t")
    chosen = (rows.select("lang", "id", *key).distinct().withColumn("n", F.row_number().over(order))
              .where(F.col("n") <= each).select("lang", "id", "t"))
    # at most ``each`` rows per language, repeated ones once
    got = (rows.withColumn("t", key[1]).join(F.broadcast(chosen), ["lang", "id", "t"], "left_semi").dropDuplicates(["lang", "id", "t"])
           .select("text").mapInArrow(_gram_rows, "two binary, three binary, four binary").toArrow())
    sets = [[np.frombuffer(b, dtype=np.int64) for b in r] for r in zip(*(got.column(c).to_pylist() for c in ("two", "three", "four")))]
    grams, marks = landmark_matrix(sets)
    parts = rows.select("text", "lang").mapInArrow(_moments(spark.sparkContext.broadcast((grams, marks)), langs), "part int, sums binary")
    weights = solve(marks, sum_arrays(parts), len(langs))
    return KernelModel(langs, grams, marks, weights.astype(np.float32))


def _predict(shared):
    def run(batches):
        model = shared.value
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            best, value = [], []
            for _, _, p in _blocks(texts, model.grams):
                if model.langs:
                    v = model.values(p)
                    best.append(v.argmax(axis=1))
                    value.append(v.max(axis=1).astype(np.float64))
                else:
                    best.append(np.full(len(p), -1))
                    value.append(np.zeros(len(p)))
            if best:
                names = np.array([*model.langs, "und"], dtype=object)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("letters"), pa.array(names[np.concatenate(best)], type=pa.string()),
                     pa.array(np.clip((1 + np.concatenate(value)) / 2, 0, 1))],
                    ["doc_id", "letters", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: KernelModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1, from the best value in -1 to 1)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["letters"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), schema)
    return out.select("doc_id", F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                      F.when(F.col("letters") & (F.col("lang_pred") != "und"), F.col("score")).otherwise(0.0).alias("score"))
