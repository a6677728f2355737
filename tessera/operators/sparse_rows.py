"""Sparse rows as packed blocks, and sums over them the size of a model.

Iterative fits over sparse rows (text features) read the same rows many times. Here rows are
packed once: a block is a table row with some thousand rows' ids, lengths, column numbers and
values as four binary columns, so that a pass costs a task no conversion. A pass is one
``mapInArrow`` over the blocks with the model broadcast; what a task adds up leaves it as the
nonzero entries of its sum, cut into chunks, is merged by chunk in other tasks, and reaches
the driver as one array of the model's size. Models beyond ``MODEL_BYTES`` are not for this
form (callers check, and have a joined form for them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import with_row_index
from tessera.operators.text_features import FREQUENT, idf_table, with_words, word_counts
from tessera.session import forget, written

BLOCK_ENTRIES = 1 << 18     # entries of a block, about (one row at least)
MODEL_BYTES = 256 << 20     # of a model that is broadcast, and of a task's sum
CHUNK = 1 << 17             # entries of a chunk of a sum
COLLECT_BYTES = 8 << 20     # of all tasks' sums that the driver takes as they are
CLOSURE_BYTES = 1 << 16     # of a model that isn't worth a broadcast
DENSE = 8                   # cells of a dense matrix for each entry, at most
TASK_ENTRIES = 1 << 22      # entries that a task of a pass takes, at most about

PACKED = "ids binary, at binary, cols binary, vals binary, extra binary"
PARTS = "part bigint, keys binary, sums binary"


@dataclass
class Block:
    """Rows at[i] .. at[i + 1] of (cols, vals); ``extra`` holds a number per row (a label)."""
    ids: np.ndarray
    at: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    extra: np.ndarray
    row: np.ndarray = field(init=False)

    def __post_init__(self):
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.at))

    def dot(self, m: np.ndarray) -> np.ndarray:
        """Rows times a matrix by column number (columns, k) -> (rows, k)."""
        return self.fold(self.vals[:, None] * m[self.cols])

    def table(self, columns: int) -> np.ndarray | None:
        """The rows as a dense matrix (rows, columns), where that is no more than some times their
        entries. A row names a column once."""
        if len(self.ids) * columns > DENSE * len(self.cols):
            return None
        out = np.zeros((len(self.ids), columns))
        out[self.row, self.cols] = self.vals
        return out

    def fold(self, entries: np.ndarray) -> np.ndarray:
        """Sum of the entries' values (entries, k) by row."""
        out = np.zeros((len(self.ids), entries.shape[1]))
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            out[some] = np.add.reduceat(entries, self.at[some], axis=0)
        return out


def _pack(batches):
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = batch.column("cols").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        cols = batch.column("cols").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        vals = batch.column("vals").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ids, extra = batch.column("id").to_numpy(), batch.column("extra").to_numpy(zero_copy_only=False).astype(np.float64)
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK_ENTRIES, side="right")) - 1)
            parts = (ids[lo:hi], at[lo:hi + 1] - at[lo], cols[at[lo]:at[hi]], vals[at[lo]:at[hi]], extra[lo:hi])
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["ids", "at", "cols", "vals", "extra"])
            lo = hi


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a table dealt evenly to as many tasks as there are cores (to a multiple of that where a
    task had too much), for fits of many passes: a pass is as long as its longest task, and a task
    costs some milliseconds however little it does."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    entries = rows.agg(F.sum(F.size("cols"))).first()[0] or 0
    return rows.repartition(cores * max(1, -(-entries // (cores * TASK_ENTRIES))))


def pack(rows: DataFrame) -> DataFrame:
    """(id bigint, cols array<int>, vals array<double>, extra double) -> packed blocks, persisted."""
    rows = rows.select(F.col("id").cast("bigint"), F.col("cols").cast("array<int>"), F.col("vals").cast("array<double>"),
                       F.col("extra").cast("double"))
    return rows.mapInArrow(_pack, PACKED).persist(StorageLevel.MEMORY_AND_DISK)


def summary_block(rows: DataFrame, limit: int = 1 << 16) -> Block | DataFrame:
    """Rows that count equal ones as one: where at most ``limit`` different ones remain, a block to
    pass over where the model is; else packed blocks."""
    few = rows.limit(limit + 1).persist()
    try:
        if few.count() > limit:
            return pack(rows)
        got = few.orderBy("cols", "vals").toArrow()
        size = got.column("cols").combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if got.num_rows else np.zeros(0, dtype=np.int64)
        flat = [got.column(c).combine_chunks().flatten().to_numpy() if got.num_rows else np.zeros(0) for c in ("cols", "vals")]
        return Block(got.column("id").to_numpy(), np.concatenate([[0], np.cumsum(size)]).astype(np.int64), flat[0].astype(np.int32), flat[1],
                     got.column("extra").to_numpy())
    finally:
        few.unpersist()


def unpacked(batches) -> Iterator[Block]:
    for batch in batches:
        for r in range(batch.num_rows):
            ids, at, cols, vals, extra = (batch.column(c)[r].as_buffer() for c in ("ids", "at", "cols", "vals", "extra"))
            yield Block(np.frombuffer(ids, np.int64), np.frombuffer(at, np.int64), np.frombuffer(cols, np.int32),
                        np.frombuffer(vals, np.float64), np.frombuffer(extra, np.float64))


def tfidf_rows(docs: DataFrame, id_col: str, text_col: str = "text", unit: bool = True, signs: Column | None = None,
               bits: int = 0) -> tuple[DataFrame, DataFrame]:
    """TF-IDF of a corpus as rows (id, cols, vals, extra), scaled to unit norm if asked, and its
    vocabulary (word, df, idf, number), both written to the shared folder. Words are numbered from
    the most frequent on, so that a block's entries meet few parts of a model; words of every
    document have weight 0 and no number, documents without any weighted word no row.

    ``signs`` is a number by ``word`` whose first ``bits`` bits are the word's signs on as many
    hyperplanes; ``extra`` is then the row's signature (see ``_listed``), else 0."""
    counts = written(word_counts(docs, id_col, text_col), "counts")
    words = vocabulary(counts, docs.count())
    known = words if signs is None else words.withColumn("h", signs.bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
    weights = with_words(counts, known).select(
        F.col(id_col).cast("bigint").alias("id"), "number", (F.col("count") * F.col("idf")).alias("v"), *(["h"] if bits else []))
    out = written(rows_of(weights, unit, bits), "tfidf")
    forget(counts)
    return out, words


def vocabulary(counts: DataFrame, n_docs: int) -> DataFrame:
    """(word, df, idf, number) of a corpus' word counts, written to the shared folder."""
    words = with_row_index(idf_table(counts, n_docs), [F.col("idf"), F.col("word")], "number")
    return written(words.withColumn("number", F.col("number").cast("int")), "vocabulary")


def _matching(entries: DataFrame, asked: DataFrame) -> DataFrame:
    """Entries of the asked words (word, number): broadcast where they measure at most ``FREQUENT``."""
    return entries.join(F.broadcast(asked) if asked.count() <= FREQUENT else asked, "word")


def asked_tfidf_rows(counts: DataFrame, n_docs: int, id_col: str, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``tfidf_rows`` for a search by the words of ``queries`` (id, word, count) in a written table of a corpus'
    ``counts``: unit rows by the norm over all words, of which only the entries that a query can meet are
    kept; and the queries' unit rows. Rows that share no word with any query are left out."""
    words = vocabulary(counts, n_docs)
    asked = written(queries.join(words, "word"), "queries")
    known = asked.select("word", "idf", "number").distinct()
    norms = (with_words(counts, words.select("word", "df", "idf")).groupBy(id_col)
             .agg(F.sqrt(F.sum(F.col("count") * F.col("idf") * F.col("count") * F.col("idf"))).alias("norm")))
    hits = _matching(counts, known).join(norms, id_col).select(
        F.col(id_col).cast("bigint").alias("id"), "number", (F.col("count") * F.col("idf") / F.col("norm")).alias("v"))
    of_queries = asked.select(F.col("id").cast("bigint").alias("id"), "number", (F.col("count") * F.col("idf")).alias("v"))
    return rows_of(hits), rows_of(of_queries, unit=True)


def asked_count_rows(counts: DataFrame, id_col: str, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``asked_tfidf_rows``, weighted by plain counts; words that no text has count for the queries' norms."""
    queries = written(queries, "queries")
    asked = written(with_row_index(queries.select("word").distinct(), [F.col("word")], "number"), "vocabulary")

    def rows(entries, key):
        norms = entries.groupBy(key).agg(F.sqrt(F.sum(F.col("count") * F.col("count"))).alias("norm"))
        hits = _matching(entries, asked).join(norms, key)
        return rows_of(hits.select(F.col(key).cast("bigint").alias("id"), "number", (F.col("count") / F.col("norm")).alias("v")))
    return rows(counts, id_col), rows(queries, "id")


def _listed(unit: bool, bits: int = 0):
    """Entries sorted by (id, number) -> rows; a row that goes on in the next batch waits for it.
    With signs (column h), ``extra`` is the signature: bit b is set when the sum of the row's values,
    signed by bit b of their words, is not negative (rounded to 9 places)."""
    def rows(parts):
        ids, number, v, *h = (np.concatenate(c) for c in zip(*parts))
        start = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        size = np.diff(np.append(start, len(ids)))
        keep = np.ones(len(start), dtype=bool)
        if unit:
            norm = np.sqrt(np.add.reduceat(v * v, start))
            keep = norm > 0
            entry = np.repeat(keep, size)
            v = v[entry] / np.repeat(norm[keep], size[keep])
            number, h = number[entry], [x[entry] for x in h]
        extra = np.zeros(int(keep.sum()))
        if bits and len(extra):
            first = np.cumsum(size[keep]) - size[keep]
            for b in range(bits):
                total = np.add.reduceat(np.where(h[0] >> b & 1, v, -v), first)
                extra += np.where(np.round(total, 9) >= 0, float(1 << b), 0.0)
        at = pa.array(np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[start][keep]), pa.ListArray.from_arrays(at, pa.array(number)), pa.ListArray.from_arrays(at, pa.array(v)),
             pa.array(extra)], ["id", "cols", "vals", "extra"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            part = [batch.column(c).to_numpy() for c in ("id", "number", "v", *(["h"] if bits else []))]
            if n >= BLOCK_ENTRIES:
                # the rows before this batch's first id are complete, and so is that id's if it changes here
                cut = int(np.searchsorted(part[0], held[-1][0][-1], side="right"))
                if cut < len(part[0]):
                    yield rows([*held, [c[:cut] for c in part]])
                    held, n, part = [], 0, [c[cut:] for c in part]
            held.append(part)
            n += len(part[0])
        if held:
            yield rows(held)
    return run


def rows_of(weights: DataFrame, unit: bool = False, bits: int = 0) -> DataFrame:
    """(id, number, v) -> rows (id, cols, vals, extra 0) with ascending columns, scaled to unit norm if
    asked (then without rows of norm 0). Entries without an id are left out. With ``bits``, entries
    have signs (h int) and ``extra`` is a signature."""
    entries = weights.where("id is not null").select(F.col("id").cast("bigint"), F.col("number").cast("int"), F.col("v").cast("double"),
                                                     *(["h"] if bits else []))
    entries = entries.repartition("id").sortWithinPartitions("id", "number")
    return entries.mapInArrow(_listed(unit, bits), "id bigint, cols array<int>, vals array<double>, extra double")


def count_rows(docs: DataFrame, id_col: str, without: list[str], text_col: str = "text", unit: bool = False) -> tuple[DataFrame, DataFrame]:
    """Word counts of a corpus as rows (id, cols, vals, extra) without the given words, scaled to unit
    norm if asked, and the vocabulary (word, df, number), both written to the shared folder."""
    counts = written(word_counts(docs, id_col, text_col).where(~F.col("word").isin(without)), "counts")
    df = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    words = with_row_index(df, [F.desc("df"), F.col("word")], "number")
    words = written(words.withColumn("number", F.col("number").cast("int")), "vocabulary")
    weights = with_words(counts, words).select(F.col(id_col).cast("bigint").alias("id"), "number", F.col("count").alias("v"))
    out = written(rows_of(weights, unit), "rows")
    forget(counts)
    return out, words


# ------------------------------------------------------------------ sums

def nonzero_parts(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nonzero entries of a flat sum, a chunk at a time."""
    flat = total.ravel()
    for lo in range(0, len(flat), CHUNK):
        keys = np.flatnonzero(flat[lo:lo + CHUNK])
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lo // CHUNK], pa.int64()), pa.array([keys.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([flat[lo + keys].tobytes()], pa.binary())], ["part", "keys", "sums"])


def _merge(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, keys, sums in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "sums"))):
            held.setdefault(part, np.zeros(CHUNK))[np.frombuffer(keys, np.int32)] += np.frombuffer(sums, np.float64)
    for part, total in held.items():
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([keys.astype(np.int32).tobytes()], pa.binary()),
                                          pa.array([total[keys].tobytes()], pa.binary())], ["part", "keys", "sums"])


def gather(parts: DataFrame, shape: tuple[int, ...], tasks: int) -> np.ndarray:
    """Sum of the parts of so many tasks. Where all of them together are small, they come as
    they are; else a model of few chunks is merged in as many tasks as the square root of the
    shuffle partitions, a larger one by chunk: all at the same time, and then fetched one by one."""
    out = np.zeros(int(np.prod(shape)))

    def add(rows):
        for part, keys, sums in rows:
            out[part * CHUNK + np.frombuffer(bytes(keys), np.int32)] += np.frombuffer(bytes(sums), np.float64)
    if tasks * len(out) * 12 <= COLLECT_BYTES:
        found = parts.toArrow()
        add(zip(*(found.column(c).to_pylist() for c in ("part", "keys", "sums"))))
    else:
        chunks = -(-len(out) // CHUNK)
        few = max(1, int(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
        merged = parts.repartition(few) if chunks < few else parts.repartition(min(chunks, few * few), "part")
        merged = merged.mapInArrow(_merge, PARTS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merged.count()
            add(merged.toLocalIterator(prefetchPartitions=True))
        finally:
            merged.unpersist()
    return out.reshape(shape)


def sum_over(blocks: DataFrame | Block, model, shape: tuple[int, ...], add: Callable, tasks: int | None = None) -> np.ndarray:
    """One pass: ``add(total, block, model)`` adds each block into its task's array of ``shape``;
    the sum over all tasks (``tasks``: their number, asked for here if not given). Adding must not
    depend on the order of the blocks."""
    if isinstance(blocks, Block):
        total = np.zeros(shape)
        add(total, blocks, model)
        return total
    arrays = [x for x in (model if isinstance(model, tuple) else (model,)) if x is not None]
    small = all(isinstance(x, np.ndarray) for x in arrays) and sum(x.nbytes for x in arrays) <= CLOSURE_BYTES     # goes along with the task
    shared = model if small else blocks.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = np.zeros(shape)
        for block in unpacked(batches):
            add(total, block, shared if small else shared.value)
        yield from nonzero_parts(total)
    try:
        return gather(blocks.mapInArrow(run, PARTS), shape, blocks.rdd.getNumPartitions() if tasks is None else tasks)
    finally:
        if not small:
            shared.destroy()


