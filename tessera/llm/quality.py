"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of counts and shares (``FEATURES``). Every feature is cut into bins,
and boosting goes round the features in cycles: a shallow tree on the bins of one feature at
a time is fitted to the gradient and added to that feature's lookup table. The pairs that
explain most of what remains then get two-way tables the same way. A score is an intercept
plus one table entry per feature and pair: vectorised additions over bins.

Fit: on at most ``TRAIN_ROWS`` labelled rows (those with the smallest hash of their id),
with numpy on the driver; the texts' features are computed on the cluster. Scoring: every
whole text, in Arrow batches.

Defined results: null text is empty and is scored like one; labels that are null or of a
document without row are not used; a document with several labels counts with the smallest;
without any label, or with a single class, every score is the smoothed share of label 1
(0.5 without labels). Repeated rows each get their score; empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SPACE_WORD, Texts, packed, small, unpacked, word_hashes, word_spans

TRAIN_ROWS = 20_000
SCORE_BOUND = 0.3
BINS = 24
PAIR_BINS = 6
ROUNDS = 60
PAIR_ROUNDS = 30
PAIRS = 6
RATE = 0.25
FEATURES = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "punctuation", "blanks", "non_ascii",
            "marks", "bars", "lines", "line_words", "capital_words", "upper_words", "marked_words", "stutter",
            "distinct_words", "short_words", "long_words", "stops"]

_BYTE = np.arange(256)
_KINDS = {
    "upper": (_BYTE >= 65) & (_BYTE <= 90),
    "digits": (_BYTE >= 48) & (_BYTE <= 57),
    "punctuation": np.isin(_BYTE, list(b".,;:?'\"()-")),
    "blanks": np.isin(_BYTE, list(b" \t\r\n\v\f")),
    "non_ascii": _BYTE >= 128,
    "marks": np.isin(_BYTE, list(b"!#$%&*+<=>@[\\]^_`{}~/")),
    "bars": _BYTE == ord("|"),
    "newline": _BYTE == 10,
    "stops": np.isin(_BYTE, list(b".?")),
}
_LETTERS = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_MARKS = _KINDS["marks"] | (_BYTE == ord("!"))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Matrix (documents, FEATURES) of the texts in one byte array."""
    docs = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    per_byte = {k: _sums(lut[data], offsets) / np.maximum(size, 1) for k, lut in _KINDS.items()}
    starts, stops, doc = word_spans(data, offsets, SPACE_WORD)
    n = np.bincount(doc, minlength=docs).astype(np.float64)
    per = lambda flag: np.bincount(doc, weights=flag, minlength=docs) / np.maximum(n, 1)
    length = stops - starts
    if len(starts):
        h = word_hashes(data, starts, stops)
        first, last = data[starts], data[stops - 1]
        upper = np.concatenate([[0], np.cumsum(_KINDS["upper"][data])])
        letters = np.concatenate([[0], np.cumsum(_LETTERS[data])])
        shout = (upper[stops] - upper[starts] == letters[stops] - letters[starts]) & (letters[stops] - letters[starts] >= 2)
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        order = np.lexsort((h, doc))
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        distinct = np.bincount(doc[order], weights=new, minlength=docs) / np.maximum(n, 1)
    else:
        first = last = np.zeros(0, dtype=np.uint8)
        shout = same = np.zeros(0, dtype=bool)
        distinct = np.zeros(docs)
    lines = per_byte["newline"] * size + 1
    columns = [np.log1p(size), np.log1p(n), per(length), per_byte["upper"], per_byte["digits"],
               per_byte["punctuation"], per_byte["blanks"], per_byte["non_ascii"], per_byte["marks"],
               per_byte["bars"], np.log1p(lines), np.log1p(n / lines), per(_KINDS["upper"][first]), per(shout),
               per(_MARKS[last]), per(same), distinct, per(length <= 2), per(length >= 14),
               per_byte["stops"] * size / np.maximum(n, 1)]
    return np.stack(columns, axis=1)


# ------------------------------------------------------------------ the model

def _tree(g: np.ndarray, h: np.ndarray, splits: int) -> np.ndarray:
    """Leaf values per bin of a tree with up to ``splits`` cuts along ordered bins."""
    cuts = [0, len(g)]
    for _ in range(splits):
        best = (1e-9, None)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo < 2:
                continue
            a, b = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            left, right = a[:-1] ** 2 / (b[:-1] + 1), (a[-1] - a[:-1]) ** 2 / (b[-1] - b[:-1] + 1)
            gain = left + right - a[-1] ** 2 / (b[-1] + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), lo + k + 1)
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of one cut on each axis of a table."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    value = lambda a, b: a * a / (b + 1)
    r, c = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    tg, th = cg[-1, -1], ch[-1, -1]
    parts = [(cg[r, c], ch[r, c]), (cg[r, -1] - cg[r, c], ch[r, -1] - ch[r, c]), (cg[-1, c] - cg[r, c], ch[-1, c] - ch[r, c]),
             (tg - cg[r, -1] - cg[-1, c] + cg[r, c], th - ch[r, -1] - ch[-1, c] + ch[r, c])]
    gain = sum(value(a, b) for a, b in parts) - value(tg, th)
    k = int(gain.argmax())
    i, j = np.unravel_index(k, gain.shape)
    out = np.zeros(g.shape)
    leaves = [a[i, j] / (b[i, j] + 1) for a, b in parts]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaves
    return float(gain[i, j]), out


class AdditiveModel:
    """Intercept, bin edges and lookup tables of features and of pairs of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n, f = x.shape
        share = (y.sum() + 1) / (n + 2) if n else 0.5
        self.intercept = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for k in range(f)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.coarse = [np.minimum(np.arange(len(e) + 1) * PAIR_BINS // max(len(e) + 1, 1), PAIR_BINS - 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if n == 0 or y.min() == y.max():
            return
        bins = self.bins(x)
        logit = np.full(n, self.intercept)

        def gradient() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-logit))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for k in range(f):
                size = len(self.tables[k])
                if size < 2:
                    continue
                g, h = gradient()
                step = RATE * _tree(np.bincount(bins[:, k], g, size), np.bincount(bins[:, k], h, size), 3)
                self.tables[k] += step
                logit += step[bins[:, k]]
        coarse = np.stack([self.coarse[k][bins[:, k]] for k in range(f)], axis=1)
        shape = (PAIR_BINS, PAIR_BINS)

        def table(i: int, j: int, v: np.ndarray) -> np.ndarray:
            return np.bincount(coarse[:, i] * PAIR_BINS + coarse[:, j], v, PAIR_BINS ** 2).reshape(shape)

        g, h = gradient()
        gains = sorted(((_cross(table(i, j, g), table(i, j, h))[0], i, j) for i in range(f) for j in range(i + 1, f)), reverse=True)
        self.pairs = [(i, j) for _, i, j in gains[:PAIRS]]
        self.pair_tables = [np.zeros(shape) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for t, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
                g, h = gradient()
                step = RATE * _cross(table(i, j, g), table(i, j, h))[1]
                t += step
                logit += step[coarse[:, i], coarse[:, j]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        logit = np.full(len(x), self.intercept)
        for k, t in enumerate(self.tables):
            logit += t[b[:, k]]
        for t, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
            logit += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


# ------------------------------------------------------------------ on the cluster

def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def _feature_rows(batches):
    for batch in small(batches):
        texts = Texts(batch.column("text"))
        parts = [features(*texts.part(i, j)) for i, j in texts.slices()]
        if parts:
            x = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))],
                ["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        train_rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Learn from the labelled documents in ``labels`` (doc_id, label)."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # at most train_rows pairs of numbers
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["label"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    got = rows.mapInArrow(_feature_rows, schema).toArrow().sort_by("doc_id")
    if got.num_rows == 0:
        return AdditiveModel(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(got.num_rows, len(FEATURES))
    return AdditiveModel(x, got.column("label").to_numpy().astype(np.float64))


def _scores(shared, carry: list[str]):
    def run(batches):
        model = shared.value
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            parts = [model.score(features(*texts.part(i, j))) for i, j in texts.slices()]
            if parts:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(np.concatenate(parts))],
                                                 [*carry, "score"])
    return run


def score(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, score (0 to 1) and, with ``carry``, the struct ``row`` of
    these columns."""
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"), *packed(docs, carry, text))
    keep = [c for c in rows.columns if c != "text" or text in carry]
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model), keep), schema)
    return out.select("doc_id", "score", *unpacked(carry, text))
