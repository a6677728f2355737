"""Benchmark decontamination: prefix-filtered set join with exact containment.

Both sides are sets of word shingles: a benchmark item becomes its item-sized windows (runs
of ``WINDOW`` words; an item of fewer words is one window), a window the set of its runs of
``SHINGLE`` words. Shingles are ordered by rarity (documents that hold them, counted over
the whole corpus, then by hash). Containment of a whole window leaves a necessary prefix of
one token, the rarest: only documents with that shingle are candidates. Its place in the
window fixes where the window must start; starts before the document or ends behind it fall
out (positional and length bounds), the rest is verified word by word.

The benchmark's index is broadcast in blocks of at most ``BLOCK_BYTES`` of item text; the
size is measured first and a larger benchmark takes more passes, one block each.

Defined results: null or empty texts have no words and are never hit; an empty benchmark
hits nothing; an item id that repeats is one item; items without id hit words but are not
listed; repeated documents each get their row. Words are compared by 64-bit hashes each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import (ALNUM_WORD, Texts, mix64, packed, ranges, shingle_hashes, unpacked, word_hashes,
                                word_spans, small)

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20


def _doc_words(data: np.ndarray, offsets: np.ndarray):
    """Word hashes of a slice and the first word of each document."""
    starts, stops, _ = word_spans(data, offsets, ALNUM_WORD)
    return word_hashes(data, starts, stops), np.searchsorted(starts, offsets)


def _sized(words: np.ndarray, k: int) -> np.ndarray:
    """Shingle hashes that also tell the shingle's size."""
    return mix64(shingle_hashes(words, k) + np.uint64(k))


def _whole(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the shingle positions 0 .. n - k lie within one document."""
    ok = np.ones(max(n - k + 1, 0), dtype=bool)
    cut = first[1:-1]
    for i in range(1, k):
        at = cut - i
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


class Windows:
    """Distinct item windows of one block: ``words`` (matrix, zero beyond ``size``) and the
    items of each (``item_at``, ``items`` as texts, null ids left out)."""

    def __init__(self, ids: list, texts: pa.Array, window: int):
        t = Texts(texts)
        rows: dict[tuple, set] = {}
        for i in range(t.n):
            data, offsets = t.part(i, i + 1)
            words, _ = _doc_words(data, offsets)
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                rows.setdefault(tuple(words[at:at + size].tolist()), set()).add(ids[i])
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.words = np.zeros((len(rows), window), dtype=np.uint64)
        for i, r in enumerate(rows):
            self.words[i, :len(r)] = r
        self.items = [[x for x in s if x is not None] for s in rows.values()]
        self.sizes = sorted({min(SHINGLE, int(s)) for s in self.size})
        shingles = [[int(x) for x in _sized(self.words[i, :s], min(SHINGLE, int(s)))] for i, s in enumerate(self.size)]
        self.shingles = shingles
        self.known = np.unique(np.array([x for s in shingles for x in s], dtype=np.uint64))

    def index(self, frequency: np.ndarray) -> dict:
        """Prefix index: for each window its rarest shingle and that shingle's place."""
        df = dict(zip(self.known.tolist(), frequency.tolist(), strict=True))
        rarest = [min(range(len(s)), key=lambda o, s=s: (df[s[o]], s[o], o)) for s in self.shingles]
        token = np.array([s[o] for s, o in zip(self.shingles, rarest, strict=True)], dtype=np.uint64)
        order = np.argsort(token, kind="stable")
        tokens, at, n = np.unique(token[order], return_index=True, return_counts=True)
        return {"tokens": tokens, "at": at, "n": n, "window": order, "place": np.array(rarest, dtype=np.int64),
                "size": self.size, "words": self.words, "items": self.items, "sizes": self.sizes}


def _find(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of ``x`` that ``sorted_keys`` holds, and where it holds them."""
    if len(sorted_keys) == 0 or len(x) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z
    # a 64 K bit map of the keys' top bits leaves few candidates for the search
    bits = np.zeros(1 << 16, dtype=bool)
    bits[(sorted_keys >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(x >> np.uint64(48)).astype(np.int64)])
    i = np.minimum(np.searchsorted(sorted_keys, x[maybe]), len(sorted_keys) - 1)
    ok = sorted_keys[i] == x[maybe]
    return maybe[ok], i[ok]


def _frequencies(known, sizes: list[int]):
    """Texts → (shingle number, documents) per batch, for the shingles in ``known``."""
    def run(batches):
        keys = known.value
        for batch in small(batches):
            t = Texts(batch.column("text"))
            total = np.zeros(len(keys), dtype=np.int64)
            for i, j in t.slices():
                words, first = _doc_words(*t.part(i, j))
                for k in sizes:
                    at, which = _find(keys, _sized(words, k))
                    ok = _whole(first, len(words), k)[at]
                    at, which = at[ok], which[ok]
                    doc = np.searchsorted(first, at, side="right") - 1
                    pair = np.unique(doc * len(keys) + which)
                    total += np.bincount(pair % len(keys), minlength=len(keys))
            got = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(total[got])], ["k", "n"])
    return run


def _hits(words: np.ndarray, first: np.ndarray, ix: dict):
    """(start, window) of each verified occurrence in the slice."""
    starts, which = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for k in ix["sizes"]:
        at, tok = _find(ix["tokens"], _sized(words, k))
        n = ix["n"][tok]
        win = ix["window"][ranges(ix["at"][tok], n)]
        start = np.repeat(at, n) - ix["place"][win]
        doc = np.searchsorted(first, np.repeat(at, n), side="right") - 1
        size = ix["size"][win]
        ok = (start >= first[doc]) & (start + size <= first[doc + 1]) & (np.minimum(size, SHINGLE) == k)
        start, win, size = start[ok], win[ok], size[ok]
        for off in range(ix["words"].shape[1]):
            inside = off < size
            at_word = np.minimum(start + off, len(words) - 1)
            ok = ~inside | (words[at_word] == ix["words"][win, off])
            start, win, size = start[ok], win[ok], size[ok]
        starts.append(start)
        which.append(win)
    return np.concatenate(starts), np.concatenate(which)


def _join(index, carry: list[str], again: bool):
    def run(batches):
        ix = index.value
        for batch in small(batches):
            t = Texts(batch.column("text"))
            n_words, hits, items = [], [], []
            for i, j in t.slices():
                words, first = _doc_words(*t.part(i, j))
                start, win = _hits(words, first, ix) if len(words) else (np.zeros(0, np.int64),) * 2
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + ix["size"][win], -1)
                hit = np.cumsum(edge[:-1]) > 0
                doc = np.searchsorted(first, start, side="right") - 1
                named: dict[int, set] = {}
                for d, w in zip(doc.tolist(), win.tolist(), strict=True):
                    named.setdefault(d, set()).update(ix["items"][w])
                at = np.flatnonzero(hit)
                own = np.searchsorted(first, at, side="right") - 1
                for d in range(j - i):
                    row = i + d
                    old_hits = batch.column("hit_words")[row].as_py() if again else []
                    old_items = batch.column("items")[row].as_py() if again else []
                    if d in named or old_hits:
                        hits.append(sorted({*old_hits, *(at[own == d] - first[d]).tolist()}))
                        items.append(sorted({*old_items, *named.get(d, ())}))
                    else:
                        hits.append([])
                        items.append([])
                n_words.append(np.diff(first))
            if n_words:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text"), *(batch.column(c) for c in carry), pa.array(np.concatenate(n_words)),
                     pa.array(hits, type=pa.list_(pa.int64())), pa.array(items, type=pa.list_(pa.string()))],
                    ["text", *carry, "n_words", "hit_words", "items"])
    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> list[int]:
    """Number of blocks so that each has about ``limit`` bytes of item text."""
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return list(range(max(1, -(-int(size) // limit))))


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", carry: tuple[str, ...] = (),
                       window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, hit_words (positions inside an occurrence of an
    item window), items (ids as sorted texts) and, with ``carry``, the struct ``row``."""
    spark = docs.sparkSession
    out = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"), *packed(docs, carry, text))
    source = docs.select(F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text"))
    blocks = _blocks(items, "id", "text", block_bytes)
    own = [c for c in out.columns if c != "text"]
    schema = T.StructType([out.schema["text"], *(out.schema[c] for c in own), T.StructField("n_words", T.LongType()),
                           T.StructField("hit_words", T.ArrayType(T.LongType())),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    for b in blocks:
        # at most about block_bytes of text: its size was measured above
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(len(blocks))) == b).toArrow()
        w = Windows(part.column("id").to_pylist(), part.column("text").combine_chunks(), window)
        frequency = np.zeros(len(w.known), dtype=np.int64)
        if len(w.known):
            counts = source.mapInArrow(_frequencies(spark.sparkContext.broadcast(w.known), w.sizes), "k bigint, n bigint")
            for r in counts.groupBy("k").agg(F.sum("n").alias("n")).toLocalIterator():
                frequency[r["k"]] = r["n"]
        index = spark.sparkContext.broadcast(w.index(frequency))
        out = out.mapInArrow(_join(index, own, b > 0), schema)
    return out.select("doc_id", "n_words", "hit_words", "items", *unpacked(carry, text))
