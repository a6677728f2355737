"""Periodic runs of words: an online sparse diagonal recurrence per text.

A run of period q is a stretch of words that are equal to the word q places before, kept as
long as no neighbouring word extends it; it counts from ``LEAST`` words and ``REPEATS``
periods on. The recurrence visits the words in order and holds, for each *active lag*, how
many words in a row have matched the word that far before them. An earlier occurrence of the
word raises its lag's length by one; a lag that the word doesn't match ends there, and its run
is emitted at once if it is long enough.

A frequent word has as many earlier occurrences as there are words, so they are sifted first,
without loss: in a run of smallest period q, any L >= q words in a row (that lie at least a
period after its start) occurred last exactly q words before, because a period can't be a
repetition of something shorter. With L the power of two from q on, a word therefore needs at
most one earlier occurrence for each power of two: the nearest one that shares the L words up
to it, if it is L / 2 to L words away. A lag that is a multiple of the smallest period never
shows up. The nearest occurrences come from direct comparison for L <= 8 and from sorting the
hashes of L words for larger ones, which only words reach whose L / 2 words occur twice in
their text. So a text of n words costs O(n log n) even if all its words are equal.

Words are compared by 64-bit hashes mixed with their text.

Defined results: a null text has no words, like an empty one; equal rows get equal results;
a missing id is kept; an empty table gives an empty table. Only the id and the text are read,
so other columns can't clash. A text of any length is one piece of work (some 100 bytes a word).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import (
    EXACT, SPACE_WORD, Texts, mix64, offsets_of, ranges, small, word_hashes, word_spans,
)

LEAST = 6       # words of a run, at least
REPEATS = 4     # periods of a run, at least
DENSE = 8       # L up to which lags are compared directly

_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_GRAM = np.uint64(0x9E3779B97F4A7C15)


def earlier_occurrences(words: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and lags of the earlier occurrences that a run can need, by word, then lag.
    ``words`` are hashes that differ between texts, ``room`` counts the words before each one
    in its text."""
    n = len(words)
    at, lags = [], []
    gram, size = words, 1
    some = None                     # words whose last `size` words occur twice; None: not sifted yet
    while size <= DENSE or len(some):
        if size <= DENSE:
            near = np.zeros(n, dtype=np.int64)
            for q in range(min(size, n - 1), 0, -1):
                same = np.flatnonzero(gram[q:] == gram[:-q]) + q
                near[same[room[same] >= size + q - 1]] = q
            hit = np.flatnonzero(near > size // 2)
            at.append(hit)
            lags.append(near[hit])
        else:
            keys = gram[some]
            order = np.argsort(keys, kind="stable")
            keys, place = keys[order], some[order]
            same = keys[1:] == keys[:-1]
            lag = place[1:] - place[:-1]
            hit = np.flatnonzero(same & (lag > size // 2) & (lag <= size))
            at.append(place[1:][hit])
            lags.append(lag[hit])
            twice = np.zeros(len(place), dtype=bool)
            twice[1:] = same
            twice[:-1] |= same
            some = np.sort(place[twice])
        size *= 2
        if size > DENSE:
            some = np.arange(n) if some is None else some
            some = some[room[some] >= size - 1]
        if n > size // 2:
            longer = np.zeros(n, dtype=np.uint64)
            longer[size // 2:] = mix64(gram[size // 2:] * _GRAM + gram[:-(size // 2)])
            gram = longer
        elif size > DENSE:
            break
    at, lags = np.concatenate(at), np.concatenate(lags)
    order = np.lexsort((lags, at))
    return at[order], lags[order]


def walk(at: list[int], lags: list[int], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) in the order in which they end."""
    runs: list[tuple[int, int, int]] = []
    need = {}

    def emit(ended: dict[int, int], last: int) -> None:
        for q, n in ended.items():
            if q not in need:
                shared = 1 << (q - 1).bit_length()      # the L words that every entry stands for
                need[q] = shared - 1 + q, max(least, repeats * q)
            more, enough = need[q]
            if n + more >= enough:
                runs.append((last + 1 - n - more, n + more, q))

    before: dict[int, int] = {}     # active lags up to the word before and not yet matched by this one
    active: dict[int, int] = {}     # lags this word matches
    word = -2
    for i, q in zip(at, lags):
        if i != word:
            if before:
                emit(before, word - 1)
            if i == word + 1:
                before, active = active, {}
            else:
                if active:
                    emit(active, word)
                before, active = {}, {}
            word = i
        active[q] = before.pop(q, 0) + 1
    emit(before, word - 1)
    emit(active, word)
    return runs


def _slice(data: np.ndarray, offsets: np.ndarray):
    """Of each text: number of words, number of runs; the runs by text, start and period; the
    kept words as bytes and their sizes by text."""
    starts, stops, doc = word_spans(data, offsets, SPACE_WORD)
    texts = len(offsets) - 1
    n_words = np.bincount(doc, minlength=texts)
    first = offsets_of(n_words)
    mine = mix64(word_hashes(data, starts, stops, EXACT) + mix64(doc.astype(np.uint64) + np.uint64(1)))
    at, lags = earlier_occurrences(mine, np.arange(len(doc)) - first[doc]) if len(doc) else (np.zeros(0, int),) * 2
    runs = np.array(sorted((s, q, n) for s, n, q in walk(at.tolist(), lags.tolist())), dtype=np.int64).reshape(-1, 3)
    begin, period, length = runs.T
    owner = doc[begin] if len(begin) else np.zeros(0, dtype=np.int64)
    # a word after a run's first period goes
    change = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, begin + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    left = np.bincount(doc[kept], minlength=texts)
    # each kept word takes the byte after it along; all but a text's last one become a space
    size = stops[kept] - starts[kept] + 1
    last = np.zeros(len(kept), dtype=bool)
    last[(np.cumsum(left) - 1)[left > 0]] = True
    padded = np.append(data, np.uint8(32))
    body = padded[ranges(starts[kept], size)]
    ends = np.cumsum(size) - 1
    body[ends[~last]] = 32
    body = np.delete(body, ends[last])
    sizes = np.bincount(doc[kept], weights=size, minlength=texts).astype(np.int64) - (left > 0)
    return n_words, np.bincount(owner, minlength=texts), (begin - first[owner], length, period), body, sizes


def _run(batches):
    for batch in small(batches):
        texts = Texts(batch.column("text"))
        parts = [_slice(*texts.part(i, j)) for i, j in texts.slices()]
        if not parts:
            continue
        n_words, n_runs, runs, body, sizes = zip(*parts)
        fields = [pa.array(np.concatenate(c)) for c in zip(*runs)]
        listed = pa.ListArray.from_arrays(pa.array(offsets_of(np.concatenate(n_runs)).astype(np.int32)),
                                          pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
        sizes = np.concatenate(sizes)
        collapsed = pa.Array.from_buffers(pa.string(), len(sizes), [
            None, pa.py_buffer(offsets_of(sizes).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(np.concatenate(body)))])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(n_words)), listed, collapsed],
                                         ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length, period; by start,
    then period; places are word numbers from 0) and collapsed (the words that no run repeats,
    joined by one space)."""
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_run, schema)


def strongest(runs: str = "runs"):
    """The run with the most periods, as a struct (ties: the smallest start, then period);
    null without runs. Fractions are compared by cross products, exactly."""
    def better(best, r):
        more, less = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (more > less), r).otherwise(best)
    return F.aggregate(F.col(runs), F.lit(None).cast(_RUN), better)
