"""Byte-level BPE encoding and decoding with a public rank file.

Encoding: texts are split by the tokenizer's pattern (here on arrays of code points, by the
class of each character; equal to the regular expression), distinct pieces of a batch go
into matrices of similar length, one row per piece, and in every round each row merges its
leftmost pair of least rank. Ranks of pairs come from an open-addressing hash table over
pairs of token ids; the row is compacted after each merge. Pieces longer than ``LONG`` bytes
are merged one by one from a heap, by the same rule. Pieces met before come from a bounded
cache of the worker. Decoding concatenates the tokens' bytes.

Ranks must be the file's ids and hold all single bytes. The file is read on the driver and
broadcast (its size is that of a vocabulary, checked against ``MAX_RANKS``).

Defined results: a null or empty text has no tokens; any text is encoded whole; special
tokens' strings are ordinary text; repeated rows each get their row; an empty table gives an
empty result. Ids outside the vocabulary can't be decoded and raise.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Texts, _powers, mix64, offsets_of, ranges, small

LONG = 2048
CACHE = 200_000          # pieces a worker remembers
MAX_RANKS = 1 << 20
NONE = np.int32(2**31 - 1)
_CODE = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if len(tokens) > MAX_RANKS:
        raise ValueError(f"{len(tokens)} ranks are more than a vocabulary's {MAX_RANKS}")
    return tokens


class Vocabulary:
    """Tokens as one byte array, and a hash table (id, id) → id of the merged token."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.name = sha256(b"\n".join(tokens)).hexdigest()
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.starts = offsets_of(np.array([len(t) for t in tokens]))
        rank = {t: i for i, t in enumerate(tokens)}
        self.single = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [(rank[t[:k]] << 32 | rank[t[k:]], i) for i, t in enumerate(tokens)
                 for k in range(1, len(t)) if t[:k] in rank and t[k:] in rank]
        keys = np.array([k for k, _ in pairs], dtype=np.uint64)
        vals = np.array([v for _, v in pairs], dtype=np.int32)
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        slots = 1 << (64 - int(self.shift))
        self.keys = np.full(slots, np.uint64(2**64 - 1))
        self.vals = np.full(slots, NONE)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == np.uint64(2**64 - 1)
            at, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[at], self.vals[at] = keys[put], vals[put]
            done = np.zeros(len(keys), dtype=bool)
            done[put] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & (slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair is no token. Ids below 0 pad rows."""
        shape = a.shape
        keys = (a.astype(np.uint64).ravel() << np.uint64(32)) | (b.astype(np.uint64).ravel() & np.uint64(2**32 - 1))
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.vals[slot], NONE)
        left = np.flatnonzero((there != keys) & (there != np.uint64(2**64 - 1)))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.vals[slot[left[hit]]]
            left = left[~hit & (there != np.uint64(2**64 - 1))]
        out = out.reshape(shape)
        out[(a < 0) | (b < 0)] = NONE
        return out


def _merge_rows(vocab: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of byte tokens (padded with -1) → flat token ids and the number of each row."""
    n = len(ids)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rows = np.arange(n)
    rank = vocab.merged(ids[:, :-1], ids[:, 1:])
    while len(rows):
        if ids.shape[1] == 1:
            done.append((rows, ids))
            break
        j = rank.argmin(axis=1)
        at = np.arange(len(rows))
        low = rank[at, j]
        over = low == NONE
        if over.any():
            done.append((rows[over], ids[over]))
            go = ~over
            rows, ids, rank, j, low = rows[go], ids[go], rank[go], j[go], low[go]
            at = np.arange(len(rows))
            if not len(rows):
                break
        width = ids.shape[1]
        ids[at, j] = low
        keep = np.ones(ids.shape, dtype=bool)
        keep[at, j + 1] = False
        ids = ids[keep].reshape(len(rows), width - 1)
        if width == 2:
            rank = rank[:, :0]
            continue
        keep = np.ones(rank.shape, dtype=bool)
        keep[at, j] = False
        rank = rank[keep].reshape(len(rows), width - 2)
        left = np.flatnonzero(j > 0)
        rank[left, j[left] - 1] = vocab.merged(ids[left, j[left] - 1], ids[left, j[left]])
        right = np.flatnonzero(j < width - 2)
        rank[right, j[right]] = vocab.merged(ids[right, j[right]], ids[right, j[right] + 1])
    counts = np.zeros(n, dtype=np.int64)
    for r, m in done:
        counts[r] = (m >= 0).sum(axis=1)
    starts = offsets_of(counts)
    flat = np.zeros(int(starts[-1]), dtype=np.int32)
    for r, m in done:
        flat[ranges(starts[r], counts[r])] = m[m >= 0]
    return flat, counts


def merge_long(vocab: Vocabulary, piece: np.ndarray) -> np.ndarray:
    """The same merges for one long piece: a heap of (rank, place) over a linked list."""
    ids = vocab.single[piece].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = vocab.merged(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32))
    heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first.tolist()) if r != NONE]
    heapq.heapify(heap)
    known: dict[tuple[int, int], int] = {}

    def rank(a: int, b: int) -> int:
        if (a, b) not in known:
            known[a, b] = int(vocab.merged(np.array([a], dtype=np.int32), np.array([b], dtype=np.int32))[0])
        return known[a, b]

    while heap:
        low, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = low, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            r = rank(low, ids[after[i]])
            if r != NONE:
                heapq.heappush(heap, (r, i, low, ids[after[i]]))
        if before[i] >= 0:
            r = rank(ids[before[i]], low)
            if r != NONE:
                heapq.heappush(heap, (r, before[i], ids[before[i]], low))
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


def merge_pieces(vocab: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Token ids of pieces (spans of ``data``): flat ids and counts, in the order given."""
    counts = np.zeros(len(starts), dtype=np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    # rows of up to 16 bytes share a matrix with their like, longer ones with lengths up to an eighth more
    step = np.maximum((1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)) // 8, 1)
    width = np.where(sizes <= 16, sizes, -(-sizes // step) * step)
    for w in np.unique(width[sizes <= LONG]):
        mine = np.flatnonzero((width == w) & (sizes <= LONG))
        step = max(1, (1 << 20) // int(w))
        for k in range(0, len(mine), step):
            p = mine[k:k + step]
            col = np.arange(int(w))
            at = np.minimum(starts[p, None] + col, len(data) - 1)
            m = np.where(col < sizes[p, None], vocab.single[data[at]], np.int32(-1))
            flat, n = _merge_rows(vocab, m)
            counts[p] = n
            parts.append((p, flat))
    for p in np.flatnonzero(sizes > LONG):
        flat = merge_long(vocab, data[starts[p]:starts[p] + sizes[p]])
        counts[p] = len(flat)
        parts.append((np.array([p]), flat))
    begin = offsets_of(counts)
    out = np.zeros(int(begin[-1]), dtype=np.int32)
    for p, flat in parts:
        out[ranges(begin[p], counts[p])] = flat
    return out, counts


# ------------------------------------------------------------------ splitting

_CLASS: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point: letter (category L), digit (N), white space, other."""
    if not _CLASS:
        out = np.full(0x110000, OTHER, dtype=np.uint8)
        kind = {"L": LETTER, "N": DIGIT}
        for c in range(0x110000):
            k = kind.get(unicodedata.category(chr(c))[0])
            if k is not None:
                out[c] = k
        out[[0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
             0x202F, 0x205F, 0x3000]] = SPACE
        _CLASS.append(out)
    return _CLASS[0]


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offset at which each piece of the documents begins.

    Pieces are the matches of: a contraction ('s 't 're 've 'm 'll 'd); an optional blank and
    a run of letters, of digits or of other characters; white space up to the blank that
    goes with the next run.
    """
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(code)
    at_byte = np.flatnonzero((data & 0xC0) != 0x80)
    kind = char_classes()[code]
    doc = np.searchsorted(at_byte, offsets[:-1][offsets[1:] > offsets[:-1]])
    doc_first = np.zeros(n + 1, dtype=bool)
    doc_first[doc] = True
    doc_first[n] = True
    begins = doc_first[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # the last white-space character before a run of another class in the same document
    # stands by itself, or with the run if it is a blank
    final = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~doc_first[1:n])
    begins[final] = True
    blank = final[code[final] == 0x20]
    begins[blank + 1] = False
    # contractions: an apostrophe that begins a piece, followed by letters
    quote = np.flatnonzero((code[:-1] == 0x27) & begins[:-1] & ~doc_first[1:n])
    if len(quote):
        two = np.minimum(quote + 2, n - 1)
        c1 = code[quote + 1]
        c2 = np.where((quote + 2 < n) & ~doc_first[np.minimum(quote + 2, n)], code[two], 0)
        one = np.isin(c1, [ord(c) for c in "stmd"])
        pair = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        for q, size in ((quote[one], 2), (quote[~one & pair], 3)):
            begins[q + 1] = False
            after = q + size
            begins[after[after < n]] |= kind[after[after < n]] == LETTER
    return at_byte[begins]


class Encoder:
    """Pieces → token ids, with a bounded cache by the piece's 64-bit hash."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.counts = np.zeros(1 << 16, dtype=np.int64)
        self.used = 0

    @staticmethod
    def _grown(a: np.ndarray, size: int) -> np.ndarray:
        if len(a) >= size:
            return a
        out = np.zeros(max(size, 2 * len(a)), dtype=a.dtype)
        out[:len(a)] = a
        return out

    def lookup(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Slots of distinct pieces (``keys`` are their hashes); their ids are
        ``ids[starts[slot]:][:counts[slot]]`` until the next call."""
        if len(self.slot) + len(keys) > CACHE:
            self.clear()
        get = self.slot.get
        names = keys.tolist()
        slots = np.array([get(k, -1) for k in names], dtype=np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            flat, counts = merge_pieces(self.vocab, data, starts[new], sizes[new])
            base = len(self.slot)
            self.ids = self._grown(self.ids, self.used + len(flat))
            self.starts = self._grown(self.starts, base + len(new))
            self.counts = self._grown(self.counts, base + len(new))
            self.ids[self.used:self.used + len(flat)] = flat
            self.starts[base:base + len(new)] = self.used + offsets_of(counts)[:-1]
            self.counts[base:base + len(new)] = counts
            self.used += len(flat)
            slots[new] = np.arange(base, base + len(new))
            self.slot.update(zip([names[i] for i in new.tolist()], slots[new].tolist(), strict=True))
        return slots

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all documents, and the number of tokens of each."""
        begins = split_pieces(data, offsets)
        if len(begins) == 0:
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets) - 1, dtype=np.int64)
        ends = np.concatenate([begins[1:], [len(data)]])
        up, down = _powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_CODE[data] * up, out=sums[1:])
        key = mix64((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        slots = self.lookup(distinct, data, begins[first], ends[first] - begins[first])
        mine = slots[which]
        n = self.counts[mine]
        total = np.concatenate([[0], np.cumsum(n)])
        piece = np.searchsorted(begins, offsets)
        return self.ids[ranges(self.starts[mine], n)], np.diff(total[piece])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocab: Vocabulary) -> Encoder:
    """The worker's encoder for a vocabulary."""
    if vocab.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocab.name] = Encoder(vocab)
    return _ENCODERS[vocab.name]


def _binary(parts: list[np.ndarray], sizes: np.ndarray) -> pa.Array:
    body = pa.py_buffer(np.ascontiguousarray(np.concatenate(parts)).view(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets_of(sizes).astype(np.int32)), body])


def _encode(shared, carry: list[str]):
    def run(batches):
        encoder = encoder_of(shared.value)
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            parts, counts = [], []
            for i, j in texts.slices():
                ids, n = encoder.encode(*texts.part(i, j))
                parts.append(ids.astype("<u4"))
                counts.append(n)
            if not counts:
                continue
            n = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(n), _binary(parts, 4 * n)],
                [*carry, "n_tokens", "ids"])
    return run


def _decode(shared, column: str, names: list[str]):
    def run(batches):
        vocab = shared.value
        size = np.diff(vocab.starts)
        for batch in small(batches, column):
            raw = Texts(batch.column(column))
            parts, counts = [], []
            for i, j in raw.slices():
                data, offsets = raw.part(i, j)
                ids = np.frombuffer(data.tobytes(), dtype="<u4")
                n = size[ids]
                parts.append(vocab.bytes[ranges(vocab.starts[ids], n)])
                total = np.concatenate([[0], np.cumsum(n)])
                counts.append(np.diff(total[offsets // 4]))
            if counts:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), _binary(parts, np.concatenate(counts))],
                                                 [*names, "decoded"])
    return run


def share(docs: DataFrame, path: str):
    """The vocabulary of a rank file, broadcast."""
    return docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path)))


def encode(docs: DataFrame, vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(_encode(vocabulary, ["doc_id"]), schema)


def decode(encoded: DataFrame, vocabulary, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of its ids."""
    schema = T.StructType([*(f for f in encoded.schema if f.name != "decoded"), T.StructField("decoded", T.BinaryType())])
    names = [f.name for f in schema][:-1]
    return encoded.select(*names).mapInArrow(_decode(vocabulary, ids, names), schema)
