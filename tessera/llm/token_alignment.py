"""Alignment of two tokenizers' tokens by byte spans, with corpus counts of linked token ids.

Tokenizer A is a byte-level BPE of the ``tokenizers`` library, B a BPE model of
``sentencepiece`` that puts a space before a text; A gets that space too, so both encode the
same bytes. The libraries' own spans are the coarse cuts: A's character offsets and the spans
of B's token protos. Where tokens share a character (A) or a span is empty because a
character's bytes are tokens of their own (B's byte fallback), the cuts are refined by the
bytes that the tokens decode to. Joined token bytes that differ from the text's leave it
without tokens. Byte offsets where tokens of both end cut a text into groups; an A and a B
token whose byte ranges overlap are linked.

Neither vocabulary has an entry with a space behind other than white space (checked), and A's
pattern lets a match hold a space only behind white space or at its start. So both tokenizers
cut a text before the first space that follows other than white space, and a text is a
sequence of *units* (mostly a word with its space) that are encoded on their own; a task
encodes each distinct unit of a block of texts once, and keeps a bounded number of them.

Counts come in three steps, none of which gathers more than a block (some megabytes of
text): a pass writes the texts' units and, for each block, how many links each id pair has in
it; pairs are summed over blocks and get their B id's highest count; the sums return to the
blocks that hold the pair, where they are added up by unit and by text.

Defined results: a null or empty text has no tokens, nor has one that a tokenizer doesn't
reproduce: its figures are 0, its groups empty, and its pairs don't count. Equal rows get equal results and each
counts; a missing id is kept; an empty table gives an empty table. Only the id and the text
are read, so other columns can't clash. A unit of any length (a text without spaces) is one
piece of work for the libraries.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Texts, give_back, list_array, materialise, offsets_of, ranges, small


KEPT_UNITS = 100_000        # units a worker keeps from block to block, about (or a block's repeated ones)
KEPT_CHARS = 64             # of a unit that is kept, at most
ENCODED = 2048              # units encoded as one text

#: A unit: spaces, then no space behind other than white space; the last one has the spaces at the end.
UNIT = re.compile(r" *(?:\S+|[^\S ] *)+(?: +\Z)?|\A +\Z")
_MARK = "▁"


@dataclass(frozen=True)
class Files:
    """Contents of the two tokenizer files."""
    a: str
    b: bytes


def share(spark, a_path: str, b_path: str):
    """Both tokenizer files, broadcast (they are as large as the files, whatever the table)."""
    with open(a_path, encoding="utf-8") as fa, open(b_path, "rb") as fb:
        return spark.sparkContext.broadcast(Files(fa.read(), fb.read()))


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: visible bytes of Latin-1 stand for
    themselves, the others, in order, for the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


#: Places of a unit's tuple: whether both sides have its bytes; ids and byte ends of both sides,
#: byte ends of the groups and the links as id pairs (a * |B| + b), as bytes of 64-bit integers;
#: the groups written out.
GOOD, A, A_ENDS, B, B_ENDS, GROUP_ENDS, LINKS, TEXT = range(8)
_BAD = (False, b"", b"", b"", b"", b"", b"", b"")


def joined(parts) -> tuple[np.ndarray, np.ndarray]:
    """Values of all parts and the size of each."""
    parts = list(parts)
    return np.frombuffer(b"".join(parts), dtype=np.int64), sizes_of(parts)


def sizes_of(parts) -> np.ndarray:
    return np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 8


class Side:
    """Bytes and decimal digits of one side's ids."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = offsets_of(self.size)[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        text = [str(i) + " " for i in range(len(tokens))]       # the last place is for what follows
        width = len(text[-1])
        self.digits = np.frombuffer("".join(t.rjust(width) for t in text).encode(), dtype=np.uint8).reshape(-1, width)
        self.length = np.array([len(t) for t in text], dtype=np.int64)

    def spans(self, ids: np.ndarray, coarse: np.ndarray, holds: np.ndarray, data: np.ndarray):
        """Ids, byte ends, and whether the tokens have the text's bytes. A coarse end that
        doesn't hold is that of the token before and the token's own bytes."""
        total = np.cumsum(self.size[ids])
        held = np.maximum.accumulate(np.where(holds, np.arange(len(ids)), -1))
        before = held >= 0
        ends = np.where(before, coarse[held] - total[held], 0) + total
        same = int(self.size[ids].sum()) == len(data) and bool((self.bytes[ranges(self.start[ids], self.size[ids])] == data).all())
        if same and (ends != total).any():
            raise ValueError("spans and bytes of the tokens don't agree")
        return ids, ends, same


class Aligner:
    """The two tokenizers of a worker."""

    def __init__(self, files: Files):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=files.b)
        alphabet = byte_alphabet()
        entries = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=False).items())
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for i, t in entries}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if byte else p.replace(_MARK, " ").encode()
                        for p, byte in zip(pieces, self.b_byte)]
        if any(re.search(r"\S ", x.decode("utf-8", "replace")) for x in [*self.a_bytes.values(), *self.b_bytes]):
            raise ValueError("a vocabulary has an entry with a space behind other than white space")
        if [(p.begin, p.end) for p in self.b.encode("é", return_type="proto").pieces][-1] != (0, 2):
            raise ValueError("sentencepiece spans are expected in bytes")
        self.a_side = Side([self.a_bytes.get(i, b"") for i in range(max(self.a_bytes) + 1)])
        self.b_side = Side(self.b_bytes)
        self.b_byte = np.array(self.b_byte)
        self.kept: dict[str, tuple] = {}

    def a_tokens(self, text: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, coarse byte ends, and which of them hold: an offset ends a token unless the next
        token begins before it, in the same character. ``at``: byte of each character."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(ids)).reshape(-1, 2)
        return ids, at[spans[:, 1]], np.append(spans[1:, 0] >= spans[:-1, 1], np.ones(min(1, len(ids)), dtype=bool))

    def b_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of B, which puts the first space itself: spans hold but for a character's bytes."""
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids = np.array([p.id for p in pieces], dtype=np.int64)
        return ids, np.array([p.end for p in pieces], dtype=np.int64) + 1, ~self.b_byte[ids]

    def encode(self, units: list[str]) -> list[tuple]:
        """Units encoded as one text, which is cut between them; where the tokens don't give the
        text's bytes, by halves."""
        text = "".join(units)
        data = text.encode()
        raw = np.frombuffer(data, dtype=np.uint8)
        bounds = offsets_of(np.array([len(u.encode()) for u in units]))
        a, a_ends, a_same = self.a_side.spans(*self.a_tokens(text, np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))), raw)
        b, b_ends, b_same = self.b_side.spans(*self.b_tokens(text), raw)
        if not (a_same and b_same and np.isin(bounds[1:], a_ends).all() and np.isin(bounds[1:], b_ends).all()):
            if len(units) == 1:
                return [_BAD]
            half = len(units) // 2
            return self.encode(units[:half]) + self.encode(units[half:])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        # each stretch between neighbouring ends lies in one token of either side: a link
        steps = np.union1d(a_ends, b_ends)
        links = a[np.searchsorted(a_ends, steps)] * len(self.b_bytes) + b[np.searchsorted(b_ends, steps)]
        written, text_ends = self.written(a, a_ends, b, b_ends, cuts)
        columns = [[True] * len(units)]
        for ends, values in ((a_ends, a), (a_ends, None), (b_ends, b), (b_ends, None), (cuts, None), (steps, links)):
            stop = np.searchsorted(ends, bounds[1:], side="right")
            start = np.append(0, stop[:-1])
            if values is None:
                values = ends - np.repeat(bounds[:-1], stop - start)
            body = np.ascontiguousarray(values).tobytes()
            columns.append([body[i:j] for i, j in zip((8 * start).tolist(), (8 * stop).tolist())])
        stop = text_ends[np.searchsorted(cuts, bounds[1:])]
        columns.append([written[i:j] for i, j in zip(np.append(0, stop[:-1] + 1).tolist(), stop.tolist())])
        return list(zip(*columns))

    def written(self, a, a_ends, b, b_ends, cuts) -> tuple[bytes, np.ndarray]:
        """All groups written out, and the end of each group's text."""
        ga, gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)      # group of each token
        place_a = np.arange(len(a)) + np.searchsorted(gb, ga)                      # behind B's of earlier groups
        place_b = np.arange(len(b)) + np.searchsorted(ga, gb, side="right")        # behind A's up to its group
        digits, n = self.a_side.digits, len(a) + len(b)
        width = max(digits.shape[1], self.b_side.digits.shape[1])
        rows, used = np.zeros((n, width), dtype=np.uint8), np.zeros(n, dtype=np.int64)
        for place, ids, ends, side, last in ((place_a, a, a_ends, self.a_side, ord("|")), (place_b, b, b_ends, self.b_side, ord(";"))):
            rows[place, width - side.digits.shape[1]:] = side.digits[ids]
            rows[place, -1] = np.where(cuts[np.searchsorted(cuts, ends)] == ends, last, ord(","))
            used[place] = side.length[ids]
        body = rows[np.arange(width) >= width - used[:, None]]
        ends = np.cumsum(used)[np.searchsorted(gb, np.arange(len(cuts)), side="right") + np.searchsorted(ga, np.arange(len(cuts)), side="right") - 1]
        return body.tobytes(), ends - 1

    def units(self, texts: list[str]) -> list[tuple]:
        """Of each unit, its tokens: kept ones, or encoded now."""
        found = list(map(self.kept.get, texts))
        new = [i for i, f in enumerate(found) if f is None]
        # white space at the end belongs to the end of a text: nothing may follow it
        alone = {i for i in new if texts[i][-1].isspace() or len(texts[i]) > ENCODED}
        others = [i for i in new if i not in alone]
        for at in [*([i] for i in alone), *(others[lo:lo + ENCODED] for lo in range(0, len(others), ENCODED))]:
            for i, f in zip(at, self.encode([texts[i] for i in at])):
                found[i] = f
        return found

    def keep(self, units: dict[str, tuple]) -> None:
        """Units for the blocks to come; those of the last block alone where they get too many."""
        if len(self.kept) + len(units) > KEPT_UNITS:
            self.kept = {}
        self.kept.update(units)


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(shared) -> Aligner:
    """The worker's tokenizers for these files; rayon's threads would outlive the task's share of cores."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    files = shared.value
    key = hash((files.a, files.b))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(files)
    return _ALIGNERS[key]


class Numbers(dict):
    """Numbers the keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Block:
    """Some texts as numbers of their distinct units; ``units`` holds each one's tuple."""

    def __init__(self, aligner: Aligner, texts: list[str | None]):
        number = Numbers()
        rows = []
        for t in texts:
            mine = UNIT.findall(" " + t) if t else []
            rows.append(np.fromiter(map(number.__getitem__, mine), dtype=np.int64, count=len(mine)))
        names = list(number)
        self.units = aligner.units(names)
        good = np.array([u[GOOD] for u in self.units], dtype=bool)
        every = np.bincount(np.concatenate([*rows, np.zeros(0, dtype=np.int64)]), minlength=len(names))
        aligner.keep({names[i]: self.units[i] for i in np.flatnonzero(every > 1).tolist() if len(names[i]) <= KEPT_CHARS})
        self.rows = rows if good.all() else [r if good[r].all() else r[:0] for r in rows]
        self.sizes = np.array([len(r) for r in self.rows], dtype=np.int64)
        self.flat = np.concatenate([*self.rows, np.zeros(0, dtype=np.int64)])

    def totals(self, of_unit) -> np.ndarray:
        """Of each text, the sum of a figure of its units."""
        values = np.asarray(of_unit, dtype=np.int64)
        return sums(values[self.flat] if len(self.flat) else self.flat, offsets_of(self.sizes))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact sums of the parts [at[i], at[i + 1])."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _encode(shared, digest: bool):
    """Texts -> a row per text (its figures and the numbers of its units), and a row per block:
    its id pairs, ascending, their links in the block, and the pairs of each unit's links."""
    def run(batches):
        from pyspark import TaskContext
        aligner, made = _aligner(shared), TaskContext.get().partitionId() << 32
        for batch in small(batches):
            block = Block(aligner, batch.column("text").to_pylist())
            columns = list(zip(*block.units)) or [()] * len(_BAD)
            links, per_unit = joined(columns[LINKS])
            keys, of_link = np.unique(links, return_inverse=True)
            times = np.bincount(block.flat, minlength=len(per_unit))
            count = np.bincount(of_link, weights=np.repeat(times, per_unit), minlength=len(keys)).astype(np.int64)
            figures = [block.totals(sizes_of(columns[c])) for c in (A, B, GROUP_ENDS, LINKS)]
            text = columns[TEXT]
            groups = [b";".join([text[u] for u in r.tolist()]) for r in block.rows]
            groups = [(sha256(g).hexdigest() if digest else g.decode()) if len(r) else "" for g, r in zip(groups, block.rows)]
            n = batch.num_rows
            numbers = block.flat.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, made)), batch.column("doc_id"), *map(pa.array, figures), pa.array(groups),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets_of(4 * block.sizes).astype(np.int32)), pa.py_buffer(numbers)]),
                 *(pa.nulls(n, pa.list_(pa.int64())) for _ in range(2)), *(pa.nulls(n, pa.list_(pa.int32())) for _ in range(2))],
                _NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([made]), pa.nulls(1, batch.column("doc_id").type), *(pa.nulls(1, pa.int64()) for _ in _FIGURES), pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.binary()), list_array(keys, [len(keys)], pa.int64()), list_array(count, [len(keys)], pa.int64()),
                 list_array(of_link.astype(np.int32), [len(of_link)], pa.int32()), list_array(per_unit.astype(np.int32), [len(per_unit)], pa.int32())],
                _NAMES)
            made += 1
            # or the next block would be made beside this one
            block = columns = text = groups = figures = links = of_link = keys = numbers = None
    return run


_NAMES = ["block", "doc_id", *_FIGURES, "groups", "units", "pairs", "counts", "of_link", "links_of"]


def _rows_schema(doc_id: T.StructField) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    ints = T.ArrayType(T.IntegerType())
    kinds = [T.LongType(), doc_id.dataType, *[T.LongType()] * len(_FIGURES), T.StringType(), T.BinaryType(), longs, longs, ints, ints]
    return T.StructType([T.StructField(n, k) for n, k in zip(_NAMES, kinds)])


def _figures(block: pa.Table, texts: pa.Table) -> pa.Table:
    """The corpus counts of a block's pairs -> sums by unit -> sums by text."""
    total, best = (block.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("totals", "bests"))
    of_link, links_of = (block.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("of_link", "links_of"))
    at = offsets_of(links_of.astype(np.int64))
    units = Texts(texts.column("units"))
    numbers = np.frombuffer(units.data.tobytes(), dtype="<u4")
    where = units.offsets // 4
    out = [sums(sums(v[of_link], at)[numbers], where) for v in (best.astype(np.int64), total)]
    names = ["doc_id", *_FIGURES, "groups"]
    return pa.Table.from_arrays([*(texts.column(c) for c in names), *map(pa.array, out)], names=[*names, "n_best", "count_sum"])


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """pair, b, total (links corpus-wide), best (total is the highest of its B id)."""
    each = rows.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    total = (each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("total"))
             .where("total > 0").withColumn("b", F.col("pair") % width))
    total = materialise(total, "pairs")
    highest = total.groupBy("b").agg(F.max("total").alias("highest"))
    return total.join(highest, "b").select("pair", "b", "total", (F.col("total") == F.col("highest")).alias("best"))


def align(docs: DataFrame, tokenizers, width: int, doc_id: str = "doc_id", text: str = "text", digest: bool = True) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``; with
    ``digest`` the lowercase hex of its SHA-256, empty without tokens), n_links, n_best,
    count_sum. ``tokenizers`` comes from ``share``, ``width`` is the size of B's vocabulary."""
    source = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    rows = materialise(source.mapInArrow(_encode(tokenizers, digest), _rows_schema(source.schema["doc_id"])), "units")
    counted = pair_counts(rows, width)
    held = rows.where("pairs is not null").select("block", F.explode("pairs").alias("pair"))
    # a block's pairs in ascending order, as the block lists them; a pair of none of its good texts has total 0
    answer = (held.join(counted, "pair", "left").groupBy("block")
              .agg(F.sort_array(F.collect_list(F.struct("pair", F.coalesce("total", F.lit(0)).alias("total"),
                                                        F.coalesce("best", F.lit(False)).cast("long").alias("best")))).alias("x")))
    blocks = (rows.where("pairs is not null").select("block", "of_link", "links_of").join(answer, "block", "left")
              .select("block", "of_link", "links_of", F.coalesce("x.total", F.array().cast("array<bigint>")).alias("totals"),
                      F.coalesce("x.best", F.array().cast("array<bigint>")).alias("bests")))
    texts = rows.where("pairs is null").select(F.col("block").alias("of"), "doc_id", *_FIGURES, "groups", "units")
    schema = T.StructType([*(f for f in texts.schema if f.name not in ("of", "units")),
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return blocks.groupBy("block").cogroup(texts.groupBy("of")).applyInArrow(_figures, schema)


def vocabulary_size(b_path: str) -> int:
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=b_path).get_piece_size()


_SPAN = ("a_ids", "a_ends", "b_ids", "b_ends", "group_ends")


def _spans(shared):
    def run(batches):
        aligner = _aligner(shared)
        for batch in small(batches):
            block = Block(aligner, batch.column("text").to_pylist())
            columns = {c: [] for c in _SPAN}
            for row in block.rows:
                units = [block.units[u] for u in row.tolist()]
                size = np.array([np.frombuffer(u[A_ENDS][-8:], np.int64)[0] for u in units], dtype=np.int64)
                for name, of in zip(_SPAN, (A, A_ENDS, B, B_ENDS, GROUP_ENDS)):
                    values, n = joined(u[of] for u in units)
                    columns[name].append(values + np.repeat(offsets_of(size)[:-1], n) if name.endswith("_ends") else values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(columns[c], pa.list_(pa.int64())) for c in _SPAN)], ["doc_id", *_SPAN])
        give_back()
    return run


def token_spans(docs: DataFrame, tokenizers, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The tokens themselves: doc_id, a_ids, a_ends, b_ids, b_ends, group_ends (byte offsets in
    the text with the space before it; a token begins where the one before it ends)."""
    source = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    schema = T.StructType([source.schema["doc_id"], *(T.StructField(c, T.ArrayType(T.LongType())) for c in _SPAN)])
    return source.mapInArrow(_spans(tokenizers), schema)
