"""Helpers shared by the corpus operators: scratch tables, byte and word arrays, hashing.

Texts reach Python as Arrow batches. The helpers here view a batch as one byte array with
document offsets and work on slices of about half a megabyte, so memory does not follow the
batch or the corpus; only a single text longer than a slice widens it.
"""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 19
BATCH_BYTES = 8 << 20

#: Odd multiplier of the polynomial word hash, and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
EXACT = np.arange(256, dtype=np.uint8)


def _word_class(breaks) -> np.ndarray:
    lut = np.ones(256, dtype=bool)
    lut[list(breaks)] = False
    return lut


#: Byte classes of the two kinds of words (after A-Z are lower-cased; bytes over 127 belong
#: to words, so the classes hold for UTF-8 as they do for characters).
ALNUM_WORD = _word_class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SPACE_WORD = _word_class([0x20, *range(0x09, 0x0E)])


# ------------------------------------------------------------------ scratch tables

def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a cut of the lineage
    that survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once nothing lazy reads them any more."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries now rather than at the driver's
    next full collection: it does so when the plans that refer to them are collected. The
    listeners hold a finished query's plan for some moments longer."""
    for _ in range(3):
        time.sleep(1.5)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def packed(docs: DataFrame, carry: tuple[str, ...], text: str) -> list[Column]:
    """The carried columns but the text as one struct column ``row`` (none: no column), so that
    no name of the input can clash with one of the operator's."""
    others = [docs[f"`{c}`"] for c in carry if c != text]
    return [F.struct(*others).alias("row")] if others else []


def unpacked(carry: tuple[str, ...], text: str, body: str = "text") -> list[Column]:
    """All carried columns, the text among them, as one struct column ``row``."""
    if not carry:
        return []
    return [F.struct(*(F.col(body).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in carry)).alias("row")]


# ------------------------------------------------------------------ bytes and words

class Texts:
    """The texts of one Arrow column as bytes: ``data`` (uint8) and ``offsets`` (n + 1).
    A null text is an empty one."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null("")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        self.n = len(column)
        if self.n == 0 or offsets is None:
            self.offsets = np.zeros(self.n + 1, dtype=np.int64)
            self.data = np.zeros(0, dtype=np.uint8)
            return
        kind = np.int64 if wide else np.int32
        offs = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + self.n + 1]
        raw = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
        self.data = raw[int(offs[0]):int(offs[-1])]
        self.offsets = offs.astype(np.int64) - int(offs[0])

    def slices(self, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
        """Runs [i, j) of whole documents of about ``limit`` bytes."""
        i = 0
        while i < self.n:
            j = int(np.searchsorted(self.offsets, self.offsets[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), self.n)
            yield i, j
            i = j

    def part(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of documents [i, j)."""
        lo, hi = int(self.offsets[i]), int(self.offsets[j])
        return self.data[lo:hi], self.offsets[i:j + 1] - lo


def give_back() -> None:
    """Return freed memory to the system. Spark reuses its Python workers from stage to stage, and
    the allocators would keep what one stage needed at its peak through all later ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` has about ``limit`` bytes in each (one row at least), so
    that what a task makes of a batch stays bounded, however many rows Arrow puts in one."""
    for batch in batches:
        if batch.num_rows:
            for i, j in Texts(batch.column(column)).slices(limit):
                yield batch.slice(i, j - i)
    give_back()


def word_spans(data: np.ndarray, offsets: np.ndarray, word_class: np.ndarray):
    """Start and end of each word, and the index of its document. Words end at documents."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = word_class[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    first[full] = inside[full]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        m = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _R), ("down", _R_INV)):
            out = np.full(m, np.uint64(base & (2**64 - 1)))
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, case: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hash of each word (its bytes mapped by ``case``; the default lower-cases A-Z):
    differences of one running polynomial."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[case[data]] * up, out=sums[1:])
    return mix64((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries (positions 0 .. n - k)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for i in range(1, k):
        out *= np.uint64(_R)
        out ^= out >> np.uint64(29)
        out += words[i:i + n]
    return mix64(out)


def crc_bucket(ids: np.ndarray | list, modulus: int) -> np.ndarray:
    """crc32 of each id as decimal text, modulo ``modulus`` (the folds of the contracts);
    a null id counts as the empty text."""
    from zlib import crc32
    return np.fromiter((crc32(b"" if i is None else str(i).encode()) % modulus for i in ids),
                       dtype=np.int64, count=len(ids))


def offsets_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) over all (s, n)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    base = offsets_of(lengths)[:-1]
    return np.arange(total, dtype=np.int64) + np.repeat(starts - base, lengths)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column out of flat values and the length of each row."""
    return pa.ListArray.from_arrays(pa.array(offsets_of(counts).astype(np.int32)),
                                    pa.array(values, type=kind))


# ------------------------------------------------------------------ sorted streams

def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from batches sorted by ``keys``.

    A group that goes on in the next batch waits for it; callers bound the size of a group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        if held:
            same = all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys)
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        cuts = np.flatnonzero(change)
        if len(cuts) == 0:
            held.append(batch)
            continue
        if held:
            first = int(cuts[0]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = []
            rest = batch.slice(first)
            cut = int(cuts[-1]) + 1 - first
        else:
            rest, cut = batch, int(cuts[-1]) + 1
        if cut > 0:
            yield pa.Table.from_batches([rest.slice(0, cut)])
        held = [rest.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
    give_back()
