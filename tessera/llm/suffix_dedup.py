"""Removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

A byte goes if it lies in a string of ``WINDOW`` bytes that also starts in a document with a
smaller id (judged on the input; strings never cross documents).

Suffixes start in q-gram buckets (q = 8: the packed bytes are the bucket's identifier) and
buckets are refined by the identifiers at later offsets: an identifier of depth 16 is made
of those of depth 8 at offsets 0 and 8, one of depth 50 of those of depth 16 at offsets
0, 16, 32 and 34, each level reusing the one before (depth 33: offsets 0 and 17). Only sampled suffixes are sorted
across the cluster: in every window the leftmost 16-gram of least (hashed) identifier.
Equal windows sample the same offset, so all copies of a window meet in one bucket.

1. Bucket sort: sampled suffixes are dealt out and sorted by (bucket of depth 16, zone,
   document). The zone is the identifier of all bytes whose windows sample this suffix, two
   depth-50 identifiers at its ends. A suffix whose zone is also in a smaller document is
   settled: its whole zone is repeated. A bucket with a single zone needs no more.
2. Refinement: what is left of the buckets with several zones is refined by the identifiers
   of depth 33 at the sampled offset and 17 bytes before it (every window of the zone holds
   one of the two); halves that only one document has need no more.
3. The windows of the remaining halves are sorted by depth-50 identifier and document.

Buckets are read as a sorted stream with one group's minimum held, never gathered. Before
each shuffle a batch settles what it can by itself, so a frequent string sends one row per
batch and zone; settled rows are spread by document. Identifiers are 96 bits where equality
decides (64 + 32; a zone's are its own, the bucket's 64 bits come on top). Texts are shuffled
once; the joins with their marks reuse that exchange.

A text may have up to 512 MB.

Defined results: null text is empty; documents under ``WINDOW`` bytes lose nothing; rows
that share a doc_id never shorten one another, and each row gets its own result (marks carry
a check of the bytes at their place); rows without doc_id come after all others. Empty
table: empty result. Other columns are handed through on request.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Texts, materialise, mix64, packed, ranges, release_shuffles, small

WINDOW = 50
DEPTH = 16                       # of the identifiers that are sampled
SPAN = WINDOW - DEPTH + 1        # sampled positions to choose from in a window
LAST = (1 << 63) - 1             # stands for a missing doc_id

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_POS_BITS = np.uint64((1 << 30) - 1)
# a mark is the check (32 bits), three flags and the place in the text (29 bits)
_DONE = 1 << 31                  # settled before the shuffle
_LEFT = 1 << 30                  # the half before the sampled offset
_SHARED = 1 << 29                # another document has this half, known before the shuffle
_PLACE = _SHARED - 1
HALF = 17
ROWS = "key bigint, mark bigint, doc bigint"
ZONE_ROWS = "key bigint, zone bigint, mark bigint, doc bigint"
MARKS = "doc bigint, mark bigint, settled boolean"


def refine(bucket: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of twice the depth from those at an offset and at a later one."""
    out = bucket * _C1
    out ^= out >> np.uint64(32)
    out += later
    out *= _C2
    out ^= out >> np.uint64(29)
    return out


def buckets16(data: np.ndarray) -> np.ndarray:
    """Identifier of depth 16 at each offset: exact 8-byte buckets, refined once."""
    b2 = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << np.uint16(8))
    b4 = b2[:-2].astype(np.uint32) | (b2[2:].astype(np.uint32) << np.uint32(16))
    b8 = b4[:-4].astype(np.uint64) | (b4[4:].astype(np.uint64) << np.uint64(32))
    return refine(b8[:-8], b8[8:])


def depth33(b16: np.ndarray, at: np.ndarray) -> np.ndarray:
    return refine(b16[at], b16[at + HALF])


def depth50(b16: np.ndarray, at: np.ndarray) -> np.ndarray:
    b32 = refine(b16[at], b16[at + 16])
    return refine(b32, refine(b16[at + 32], b16[at + 34]))


class Zones:
    """Sampled suffixes of the documents in one byte array: ``pos`` (offset of the sampled
    16-gram), ``lo`` and ``hi`` (first and last window that samples it), ``key`` (of the bucket),
    ``zone`` (64 bits) and ``check`` (32 others) of all bytes of the zone."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data) - WINDOW + 1
        long = np.flatnonzero(np.diff(offsets) >= WINDOW)
        if n <= 0 or len(long) == 0:
            self.pos = self.lo = self.hi = np.zeros(0, dtype=np.int64)
            self.key = np.zeros(0, dtype=np.uint64)
            self.zone = self.check = np.zeros(0, dtype=np.uint64)
            self.b16 = np.zeros(0, dtype=np.uint64)
            return
        self.b16 = b16 = buckets16(data)
        m = ((b16 * _C3) & ~_POS_BITS) | np.arange(len(b16), dtype=np.uint64)
        width = 1
        while width * 2 <= SPAN:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[:n], m[SPAN - width:SPAN - width + n])
        chosen = (m & _POS_BITS).astype(np.int64)
        edge = np.zeros(n + 1, dtype=np.int32)
        edge[offsets[long]] += 1
        edge[offsets[long + 1] - WINDOW + 1] -= 1
        chosen[np.cumsum(edge[:n]) == 0] = -1       # windows that cross documents
        cut = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
        lo = np.concatenate([[0], cut])
        hi = np.concatenate([cut, [n]]) - 1
        real = chosen[lo] >= 0
        self.lo, self.hi = lo[real], hi[real]
        self.pos = chosen[self.lo]
        self.key = mix64(b16[self.pos])
        shape = (self.pos - self.lo).astype(np.uint64) << np.uint64(8) | (self.hi - self.lo).astype(np.uint64)
        self.check = mix64(refine(depth50(b16, self.lo), depth50(b16, self.hi)) + shape) >> np.uint64(32)
        # the same bytes once more, mixed in another way
        self.zone = mix64(shape)
        for at in (0, 16, 32, 34):
            for end in (self.lo, self.hi):
                self.zone = mix64(self.zone * _C2 + b16[end + at])


def _mark(check: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return ((check << np.uint64(32)) | pos.astype(np.uint64)).view(np.int64)


def _docs(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc").to_numpy(zero_copy_only=False)


def _settle_here(key: np.ndarray, mark: np.ndarray, doc: np.ndarray, flag: bool = False,
                 zone: np.ndarray | None = None) -> pa.RecordBatch | None:
    """Rows of one batch: those whose (key, zone, check) the batch also has in a smaller document
    are settled and spread by document; with ``flag`` the smallest one's rows say so."""
    if len(key) == 0:
        return None
    check = mark.view(np.uint64) >> np.uint64(32)
    order = np.lexsort((doc, check, key) if zone is None else (doc, check, zone, key))
    key, mark, doc, check = key[order], mark[order], doc[order], check[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    if zone is not None:
        zone = zone[order]
        new[1:] |= zone[1:] != zone[:-1]
    low = doc[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    done = doc > low
    if flag:
        run = np.cumsum(new) - 1
        known = np.bincount(run, weights=done)[run] > 0
        mark = np.where(known, mark | _SHARED, mark)
    key = np.where(done, mix64(mix64(doc.view(np.uint64)) + mark.view(np.uint64)), key)
    mark = np.where(done, mark | _DONE, mark)
    out = {"key": pa.array(key.view(np.int64)), "mark": pa.array(mark), "doc": pa.array(doc)}
    if zone is not None:
        # a settled row is known by its mark alone
        out = {"key": out["key"], "zone": pa.array(np.where(done, 0, zone.view(np.int64))), "mark": out["mark"], "doc": out["doc"]}
    return pa.RecordBatch.from_arrays(list(out.values()), list(out))


def sampled_suffixes(batches):
    """Texts → a row for each sampled suffix."""
    for batch in small(batches):
        texts, ids = Texts(batch.column("text")), _docs(batch)
        keys, zones, marks, docs = [], [], [], []
        for i, j in texts.slices():
            data, offsets = texts.part(i, j)
            z = Zones(data, offsets)
            own = np.searchsorted(offsets, z.pos, side="right") - 1
            keys.append(z.key)
            zones.append(z.zone)
            marks.append(_mark(z.check, z.pos - offsets[own]))
            docs.append(ids[i + own])
        if keys:
            out = _settle_here(np.concatenate(keys), np.concatenate(marks), np.concatenate(docs), zone=np.concatenate(zones))
            if out is not None:
                yield out


def _stream(batches, whole_groups: bool):
    """Rows sorted by (key, zone, check, doc), windows without zone → marks.

    Settled: zone and check are also in a smaller document. With ``whole_groups`` the others of
    a key with several of them follow, unsettled. State: the last key, zone, check and least
    document, and, while a key has had one zone, that document's own rows.
    """
    key0 = zone0 = check0 = low0 = None
    several0 = False
    wait: list[tuple[np.ndarray, np.ndarray]] = []

    def out(doc, mark, settled):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(mark & ~np.int64(_DONE)), pa.array(np.full(len(doc), settled))],
            ["doc", "mark", "settled"])

    for batch in batches:
        key, zone, mark, doc = (batch.column(c).to_numpy() for c in ("key", "zone" if whole_groups else "key", "mark", "doc"))
        done = (mark & _DONE) != 0
        if done.any():
            yield out(doc[done], mark[done], True)
            key, zone, mark, doc = key[~done], zone[~done], mark[~done], doc[~done]
        n = len(key)
        if n == 0:
            continue
        check = mark >> 32
        new_key = np.ones(n, dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new_run = new_key.copy()
        new_run[1:] |= (zone[1:] != zone[:-1]) | (check[1:] != check[:-1])
        goes_on = key0 is not None and key[0] == key0
        new_key[0] = not goes_on
        new_run[0] = not (goes_on and zone[0] == zone0 and check[0] == check0)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new_run, at, -1))
        low = np.where(start >= 0, doc[np.maximum(start, 0)], low0 if low0 is not None else 0)
        settled = doc > low
        if settled.any():
            yield out(doc[settled], mark[settled], True)
        if whole_groups:
            group = np.cumsum(new_key) - (0 if goes_on else 1)      # 0: goes on from before
            n_groups = int(group[-1]) + 1
            runs = np.bincount(group, weights=new_run, minlength=n_groups).astype(np.int64)
            if goes_on:
                runs[0] += 2 if several0 else 1
            several = runs > 1
            if wait and goes_on and several[0]:
                for d, m in wait:
                    yield out(d, m, False)
            if not goes_on or several[0]:
                wait = []
            rest = ~settled & several[group]
            if rest.any():
                yield out(doc[rest], mark[rest], False)
            several0 = bool(several[-1])
            if not several0:
                own = ~settled & (group == n_groups - 1)
                wait = [*(wait if n_groups == 1 and goes_on else []), (doc[own], mark[own])]
            else:
                wait = []
        key0, zone0, check0, low0 = key[-1], zone[-1], check[-1], low[-1]


def zone_marks(batches):
    yield from _stream(batches, True)


def window_marks(batches):
    yield from _stream(batches, False)


def shared_halves(batches):
    """Rows sorted by (key, check, doc) → all rows of a check that two documents have.
    State: the last key, check and document, and its rows while it is alone."""
    last = None
    wait: list[tuple[np.ndarray, np.ndarray]] = []

    def out(doc, mark):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(mark)], ["doc", "mark"])

    for batch in batches:
        key, mark, doc = (batch.column(c).to_numpy() for c in ("key", "mark", "doc"))
        done = (mark & _DONE) != 0
        if done.any():
            yield out(doc[done], mark[done])
            key, mark, doc = key[~done], mark[~done], doc[~done]
        n = len(key)
        if n == 0:
            continue
        check = mark >> 32
        new = np.ones(n, dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        goes_on = last is not None and (key[0], check[0]) == last[:2]
        new[0] = not goes_on
        run = np.cumsum(new) - (0 if goes_on else 1)
        n_runs = int(run[-1]) + 1
        low = np.full(n_runs, LAST)
        high = np.full(n_runs, -LAST)
        np.minimum.at(low, run, doc)
        np.maximum.at(high, run, doc)
        if goes_on:
            low[0] = min(low[0], last[2])
        several = high > low
        if goes_on and several[0]:
            for d, m in wait:
                yield out(d, m)
        if not goes_on or several[0]:
            wait = []
        take = several[run] | ((mark & _SHARED) != 0)
        if take.any():
            yield out(doc[take], mark[take])
        own = ~take & (run == n_runs - 1)
        wait = [*(wait if goes_on and n_runs == 1 else []), (doc[own], mark[own])]
        last = (key[-1], check[-1], low[-1])


def _lists(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of rows [i, j) of a list column (null: none), and the row (from 0) of each."""
    part = column.slice(i, j - i)
    lens = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(j - i), lens)


def _marked(batch: pa.RecordBatch, columns: list[str]):
    """Slices of a batch: (i, j, data, offsets, zones or None)."""
    texts = Texts(batch.column("text"))
    for i, j in texts.slices():
        data, offsets = texts.part(i, j)
        any_mark = any(len(batch.column(c).slice(i, j - i).flatten()) for c in columns)
        yield i, j, data, offsets, Zones(data, offsets) if any_mark else None


def _find(z: Zones, offsets: np.ndarray, marks: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Index of the zone each mark names; marks of another row with the same id fall out."""
    if len(marks) == 0 or len(z.pos) == 0:
        return np.zeros(0, dtype=np.int64)
    pos = offsets[row] + (marks & _PLACE)
    i = np.minimum(np.searchsorted(z.pos, pos), len(z.pos) - 1)
    ok = (z.pos[i] == pos) & (z.check[i] == marks.view(np.uint64) >> np.uint64(32)) & (pos < offsets[row + 1])
    return i[ok]


def _window_ids(z: Zones, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = depth50(z.b16, at)
    return mix64(full), mix64(full * _C3 + z.b16[at]) >> np.uint64(32)


def _half_ids(z: Zones, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = depth33(z.b16, at)
    return mix64(full), mix64(full * _C3 + z.b16[at]) >> np.uint64(32)


def open_halves(batches):
    """Texts with their unsettled zones → a row for each half of these zones: the 33 bytes
    from the sampled offset lie in the windows that begin up to 17 bytes before it, the 33
    bytes from 17 before it in the others."""
    for batch in small(batches):
        ids = _docs(batch)
        keys, marks, docs = [], [], []
        for i, j, data, offsets, z in _marked(batch, ["open"]):
            if z is None:
                continue
            k = np.unique(_find(z, offsets, *_lists(batch.column("open"), i, j)))
            own = np.searchsorted(offsets, z.pos[k], side="right") - 1
            for left in (False, True):
                some = (z.pos[k] - z.lo[k] > HALF) if left else (z.pos[k] - z.hi[k] <= HALF)
                pos, doc = z.pos[k][some], own[some]
                if len(pos) == 0:
                    continue
                key, check = _half_ids(z, pos - HALF if left else pos)
                keys.append(key)
                marks.append(_mark(check, (pos - offsets[doc]) | (_LEFT if left else 0)))
                docs.append(ids[i + doc])
        if keys:
            yield _settle_here(np.concatenate(keys), np.concatenate(marks), np.concatenate(docs), flag=True)


def open_windows(batches):
    """Texts with their shared halves → a row for each window of these halves."""
    for batch in small(batches):
        ids = _docs(batch)
        keys, marks, docs = [], [], []
        for i, j, data, offsets, z in _marked(batch, ["halves"]):
            if z is None or len(z.pos) == 0:
                continue
            vals, row = _lists(batch.column("halves"), i, j)
            pos = offsets[row] + (vals & _PLACE)
            left = (vals & _LEFT) != 0
            k = np.minimum(np.searchsorted(z.pos, pos), len(z.pos) - 1)
            ok = (z.pos[k] == pos) & np.where(left, z.pos[k] - z.lo[k] > HALF, z.pos[k] - z.hi[k] <= HALF)
            k, left, vals = k[ok], left[ok], vals[ok]
            same = _half_ids(z, np.where(left, z.pos[k] - HALF, z.pos[k]))[1] == vals.view(np.uint64) >> np.uint64(32)
            k, left = k[same], left[same]
            lo = np.where(left, z.lo[k], np.maximum(z.lo[k], z.pos[k] - HALF))
            hi = np.where(left, np.minimum(z.hi[k], z.pos[k] - HALF - 1), z.hi[k])
            at = ranges(lo, hi - lo + 1)
            if len(at) == 0:
                continue
            key, check = _window_ids(z, at)
            own = np.searchsorted(offsets, at, side="right") - 1
            keys.append(key)
            marks.append(_mark(check, at - offsets[own]))
            docs.append(ids[i + own])
        if keys:
            yield _settle_here(np.concatenate(keys), np.concatenate(marks), np.concatenate(docs))


def _removal(z: Zones | None, n: int, offsets: np.ndarray, batch: pa.RecordBatch, i: int, j: int) -> np.ndarray:
    gone = np.zeros(n, dtype=bool)
    if z is None:
        return gone
    edge = np.zeros(n + 1, dtype=np.int32)
    k = _find(z, offsets, *_lists(batch.column("settled"), i, j))
    np.add.at(edge, z.lo[k], 1)
    np.add.at(edge, z.hi[k] + WINDOW, -1)
    vals, row = _lists(batch.column("windows"), i, j)
    if len(vals):
        at = offsets[row] + (vals & _PLACE)
        inside = at + WINDOW <= offsets[row + 1]
        at, vals = at[inside], vals[inside]
        ok = _window_ids(z, at)[1] == vals.view(np.uint64) >> np.uint64(32)
        np.add.at(edge, at[ok], 1)
        np.add.at(edge, at[ok] + WINDOW, -1)
    return np.cumsum(edge[:n]) > 0


def _readable(text: pa.Array, kept: pa.Array, removed: np.ndarray) -> pa.Array:
    """Remaining bytes as text, without the bytes of characters that were cut apart."""
    if not removed.any():
        return text.cast(pa.string())
    return pa.array([b.decode("utf-8", "ignore") if cut else b.decode("utf-8")
                     for b, cut in zip(kept.to_pylist(), (removed > 0).tolist(), strict=True)], type=pa.string())


def _shorten(carry: list[str], as_text: bool):
    def run(batches):
        for batch in small(batches):
            removed, spans, sizes, kept, kept_sizes = [], [], [], [], []
            for i, j, data, offsets, z in _marked(batch, ["settled", "windows"]):
                gone = _removal(z, len(data), offsets, batch, i, j)
                total = np.concatenate([[0], np.cumsum(gone)])
                first = gone.copy()
                first[1:] &= ~gone[:-1]
                begins = offsets[:-1][offsets[:-1] < len(data)]
                first[begins] = gone[begins]
                edges = np.concatenate([[0], np.cumsum(first)])
                size = np.diff(offsets)
                lost = total[offsets[1:]] - total[offsets[:-1]]
                sizes.append(size)
                removed.append(lost)
                spans.append(edges[offsets[1:]] - edges[offsets[:-1]])
                kept.append(data[~gone] if z is not None else data)
                kept_sizes.append(size - lost)
            if not sizes:
                continue
            ends = np.concatenate([[0], np.cumsum(np.concatenate(kept_sizes))])
            body = pa.py_buffer(np.ascontiguousarray(np.concatenate(kept)))
            binary = pa.Array.from_buffers(pa.binary(), batch.num_rows,
                                           [None, pa.py_buffer(ends.astype(np.int32)), body])
            if as_text:
                binary = _readable(batch.column("text"), binary, np.concatenate(removed))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), binary, pa.array(np.concatenate(sizes)),
                 pa.array(np.concatenate(removed)), pa.array(np.concatenate(spans))],
                [*carry, "kept", "n_bytes", "n_removed", "n_spans"])
    return run


def _sorted(rows: DataFrame) -> DataFrame:
    zone = ["zone"] if "zone" in rows.columns else []
    return rows.repartition("key").sortWithinPartitions("key", *zone, F.shiftright("mark", 32), "doc")


def _listed(marks: DataFrame, name: str) -> DataFrame:
    return marks.groupBy("doc").agg(F.collect_list("mark").alias(name))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, kept (the remaining bytes, binary; ``as_text``: as
    text, without characters that were cut apart), n_bytes, n_removed, n_spans (maximal
    removed runs) and, with ``carry``, the struct ``row`` of these columns but the text."""
    others = tuple(c for c in carry if c != text)
    doc = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc")
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    marks = materialise(_sorted(docs.select(doc, body).mapInArrow(sampled_suffixes, ZONE_ROWS))
                        .mapInArrow(zone_marks, MARKS), "zones")
    release_shuffles(docs.sparkSession)
    # all joins below read the same exchange of the texts: each takes all of its columns
    rows = docs.select(doc, body, F.col(doc_id).alias("doc_id"), *packed(docs, others, text)).repartition("doc")
    halves = (_sorted(rows.join(_listed(marks.where("not settled"), "open"), "doc", "left")
                      .mapInArrow(open_halves, ROWS)).mapInArrow(shared_halves, "doc bigint, mark bigint"))
    windows = (_sorted(rows.join(_listed(halves, "halves"), "doc", "left").mapInArrow(open_windows, ROWS))
               .mapInArrow(window_marks, MARKS))
    joined = (rows.join(_listed(marks.where("settled"), "settled"), "doc", "left")
              .join(_listed(windows, "windows"), "doc", "left"))
    keep = ["doc_id", *(["row"] if others else [])]
    schema = T.StructType([*(joined.schema[c] for c in keep), T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType())])
    return joined.mapInArrow(_shorten(keep, as_text), schema)
