"""Language-model scores: corpus counts, and a small causal attention model over them.

Tokens are lower-cased words and one end per text. Base: smoothed unigram log10 probability
from the counts of all training texts. The model writes a token's probability as

    P(class of the token | tokens before it) * P(token | its class).

A word's class follows from its first subword id (the most frequent first subwords are
classes of their own, the others share hashed ones; unknown words and the end are classes
too), P(token | class) is the token's share of the class in the base distribution, and
P(class | before) comes from causal self-attention: a token is the mean of its subword ids'
(hashed) embeddings; one head attends to the window's earlier tokens with a relative-position
bias; a linear layer over the token before and what it attends to gives the classes. Windows
of 2 * ``STEP`` tokens overlap by half, so that each token is scored once, with ``STEP`` to
2 * STEP - 1 tokens before it (fewer at the start of a text), in batches with masks.

All training texts count. The attention is trained in numpy by local steps in every task over
every window of each training text, each text in one of ``ROUNDS`` rounds; after a round the
tasks' parameters are averaged by their windows.

Counting: texts are dealt into blocks of about ``BLOCK_BYTES`` by a hash of the row; a block
sends each of its distinct words once, with its subword ids, gets back the word's corpus count,
and is scored with that dictionary. A frequent word sends one row per block.

Defined results: null and empty texts have one token, the end; without training texts every
token is unknown; repeated rows each get their row; an empty table gives an empty result.
Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import bpe
from tessera.llm.common import (LOWER, SLICE_BYTES, SPACE_WORD, Texts, materialise, mix64, offsets_of, ranges,
                                word_hashes, word_spans, small)
from tessera.llm.language_id import sum_arrays

SMOOTH = 0.1
STEP = 32
DIM = 16
CLASSES = 64             # 0: unknown, 1: end
OWN_CLASS = 40           # first subwords with a class of their own
HASHED = 2048            # rows of the embedding table
ROUNDS = 2
BATCH = 128              # windows of a training step
RATE = 0.1
BLOCK_BYTES = 16 << 20
START = HASHED           # embedding row of the text's start; END follows
END = HASHED + 1


# ------------------------------------------------------------------ tokens

class Tokens:
    """Words of the texts in one byte array: ``hash`` of each, ``first`` word of each text;
    ``key`` (distinct hashes) and ``which`` (index of each word's hash)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, stops, _ = word_spans(data, offsets, SPACE_WORD)
        self.hash = word_hashes(data, starts, stops)
        self.first = np.searchsorted(starts, offsets)
        self.key, at, self.which = np.unique(self.hash, return_index=True, return_inverse=True)
        self.data, self.starts, self.sizes = LOWER[data], starts[at], (stops - starts)[at]

    def subwords(self, encoder: bpe.Encoder) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the distinct words: flat ids and counts."""
        slot = encoder.lookup(self.key, self.data, self.starts, self.sizes)
        n = encoder.counts[slot]
        return encoder.ids[ranges(encoder.starts[slot], n)], n


def first_of(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return flat[offsets_of(counts)[:-1]] if len(counts) else np.zeros(0, dtype=np.int32)


def hashed(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(HASHED)).astype(np.int64)


def class_table(mass: dict[int, float], size: int) -> np.ndarray:
    """Class of each subword id as a word's first: the heaviest have one of their own."""
    table = (OWN_CLASS + 2 + mix64(np.arange(size, dtype=np.uint64)) % np.uint64(CLASSES - OWN_CLASS - 2)).astype(np.int64)
    for rank, s in enumerate(sorted(mass, key=lambda s: (-mass[s], s))[:OWN_CLASS]):
        table[s] = 2 + rank
    return table


# ------------------------------------------------------------------ the attention model

HIGH = np.float32(60)    # exponents are held below this instead of subtracting each row's maximum
_ONES, _ONES_C = np.ones(2 * STEP, dtype=np.float32), np.ones(CLASSES, dtype=np.float32)

SHAPES = {"emb": (HASHED + 2, DIM), "wq": (DIM, DIM), "wk": (DIM, DIM), "wv": (DIM, DIM), "rel": (2 * STEP,),
          "wo": (2 * DIM, CLASSES), "bias": (CLASSES,)}


def initial(class_mass: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    p = {k: (rng.standard_normal(s) * (0.3 if k == "emb" else 0.25)).astype(np.float32) for k, s in SHAPES.items()}
    p["rel"][:] = 0
    p["wo"][:] *= 0.1
    p["bias"] = np.log(np.maximum(class_mass, 1e-12) / class_mass.sum()).astype(np.float32)
    return p


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float64)


def unpack(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (token within the text) and number of each window's scored tokens; a text
    of n words has n + 1 tokens."""
    n = np.diff(first) + 1
    count = -(-n // STEP)
    text = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(text)) - np.repeat(offsets_of(count)[:-1], count)) * STEP
    return text, start, np.minimum(n[text] - start, STEP)


_GAP = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)[None, :]    # place asked from minus place seen
_CAUSAL = _GAP >= 0


def inputs_of(first: np.ndarray, which: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct-word number of the input at each place of the windows (the token before it;
    -1: the text's start) and whether the place is in the text."""
    place = start[:, None] - STEP + np.arange(2 * STEP)[None, :]
    at = first[text][:, None] + place - 1
    inside = (place >= 0) & (at < first[text + 1][:, None])
    word = np.where(place > 0, which[np.clip(at, 0, max(len(which) - 1, 0))] if len(which) else -1, -1)
    return np.where(inside, word, -1), inside


def forward(p: dict, x: np.ndarray, inside: np.ndarray):
    """Class logits of the scored half of the windows, and what the gradient needs."""
    asked = x[:, STEP:]
    q, k, v = asked @ p["wq"], x @ p["wk"], x @ p["wv"]
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(DIM ** -0.5)
    s += p["rel"][np.clip(_GAP, 0, 2 * STEP - 1)]
    np.minimum(s, HIGH, out=s)
    s = np.where(_CAUSAL & inside[:, None, :], s, np.float32(-1e9))
    np.exp(s, out=s)
    s /= (s @ np.ones(2 * STEP, dtype=s.dtype))[:, :, None]
    h = np.concatenate([asked, s @ v], axis=2)
    return h @ p["wo"] + p["bias"], (asked, q, k, v, s, h)


def gradients(p: dict, x: np.ndarray, inside: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[dict, np.ndarray, float]:
    """Gradients of the mean cross entropy, also with respect to ``x``; and the loss."""
    logits, (asked, q, k, v, a, h) = forward(p, x, inside)
    np.minimum(logits, HIGH, out=logits)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(CLASSES, dtype=logits.dtype))[:, :, None]
    w, t = np.nonzero(real)
    loss = float(-np.log(np.maximum(logits[w, t, y[w, t]], 1e-30)).sum())
    logits[w, t, y[w, t]] -= 1
    d = logits * (real[:, :, None] / np.float32(max(1, len(w))))
    flat = d.reshape(-1, CLASSES)
    g = {"wo": h.reshape(-1, 2 * DIM).T @ flat, "bias": flat.sum(axis=0)}
    dh = d @ p["wo"].T
    do = dh[:, :, DIM:]
    da = do @ v.transpose(0, 2, 1)
    ds = a * (da - (da * a).sum(axis=2, keepdims=True))
    g["rel"] = np.bincount(np.clip(_GAP, 0, 2 * STEP - 1).ravel(), ds.sum(axis=0).ravel(), 2 * STEP).astype(np.float32)
    ds *= np.float32(DIM ** -0.5)
    dq, dk, dv = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ do
    g["wq"] = asked.reshape(-1, DIM).T @ dq.reshape(-1, DIM)
    g["wk"] = x.reshape(-1, DIM).T @ dk.reshape(-1, DIM)
    g["wv"] = x.reshape(-1, DIM).T @ dv.reshape(-1, DIM)
    dx = dk @ p["wk"].T + dv @ p["wv"].T
    dx[:, STEP:] += dh[:, :, :DIM] + dq @ p["wq"].T
    return g, dx, loss


def word_vectors(emb: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean embedding of each distinct word; the text's start as the last row (index -1)."""
    if len(counts) == 0:
        return emb[[START]]
    sums = np.add.reduceat(emb[flat], offsets_of(counts)[:-1], axis=0)
    return np.concatenate([sums / counts[:, None].astype(np.float32), emb[[START]]])


def sums_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by group number."""
    return np.stack([np.bincount(group, values[:, k], n) for k in range(values.shape[1])], axis=1).astype(np.float32)


class Trainer:
    """Local steps (Adagrad) from shared parameters."""

    def __init__(self, params: dict):
        self.p = {k: v.copy() for k, v in params.items()}
        self.seen = {k: np.full(v.shape, 1e-6, dtype=np.float32) for k, v in params.items()}
        self.windows = 0
        self.loss = 0.0
        self.tokens = 0

    def step(self, tokens: Tokens, flat: np.ndarray, counts: np.ndarray, classes: np.ndarray, text, start, size) -> None:
        word, inside = inputs_of(tokens.first, tokens.which, text, start)
        # the distinct words of these windows, the text's start (-1) first where it occurs
        used, at = np.unique(word, return_inverse=True)
        at, starts = at.ravel(), int(used[0] < 0)
        n = counts[used[starts:]]
        subs = flat[ranges(offsets_of(counts)[:-1][used[starts:]], n)]
        share = (1 / np.repeat(n, n)).astype(np.float32)[:, None]
        emb = self.p["emb"]
        vectors = np.add.reduceat(emb[subs] * share, offsets_of(n)[:-1], axis=0) if len(n) else emb[:0]
        x = np.concatenate([emb[[START]][:starts], vectors])[at].reshape(*word.shape, DIM)
        y, real = targets_of(tokens, classes, text, start, size)
        g, dx, loss = gradients(self.p, x, inside, y, real)
        dx[~inside] = 0
        # words' gradients go to their subwords, the start's to its own row; other rows don't move
        per_word = sums_by(at, dx.reshape(-1, DIM), len(used))
        rows, row = np.unique(np.concatenate([np.full(starts, START), subs]), return_inverse=True)
        parts = np.concatenate([per_word[:starts], np.repeat(per_word[starts:], n, axis=0) * share])
        change = sums_by(row, parts, len(rows))
        seen = self.seen["emb"]
        seen[rows] += change * change
        emb[rows] -= np.float32(RATE) * change / np.sqrt(seen[rows])
        for k, v in g.items():
            self.seen[k] += v * v
            self.p[k] -= np.float32(RATE) * v / np.sqrt(self.seen[k])
        self.windows += len(text)
        self.loss += loss
        self.tokens += int(real.sum())


def targets_of(tokens: Tokens, classes: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Class of each scored token (``classes``: of the distinct words) and which places are scored."""
    place = np.arange(STEP)[None, :]
    real = place < size[:, None]
    at = tokens.first[text][:, None] + start[:, None] + place
    last = at >= tokens.first[text + 1][:, None]
    word = tokens.which[np.clip(at, 0, max(len(tokens.which) - 1, 0))] if len(tokens.which) else np.zeros(at.shape, dtype=np.int64)
    cls = classes[word] if len(classes) else np.ones(at.shape, dtype=np.int64)
    return np.where(last, 1, cls), real


def _train(vocabulary, params, table):
    """Training texts → the parameters after this task's steps, times its windows."""
    def run(batches):
        trainer = Trainer(params.value)
        encoder = bpe.encoder_of(vocabulary.value)
        of = table.value
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            for i, j in texts.slices():
                tokens = Tokens(*texts.part(i, j))
                text, start, size = windows_of(tokens.first)
                flat, counts = tokens.subwords(encoder)
                classes, flat = of[first_of(flat, counts)], hashed(flat)
                for k in range(0, len(text), BATCH):
                    w = slice(k, k + BATCH)
                    trainer.step(tokens, flat, counts, classes, text[w], start[w], size[w])
        if trainer.windows:
            x = np.concatenate([pack(trainer.p) * trainer.windows, [trainer.windows, trainer.loss, trainer.tokens]])
            yield pa.RecordBatch.from_arrays([pa.array([0], type=pa.int32()), pa.array([x.tobytes()], type=pa.binary())], ["part", "sums"])
    return run


class Scores:
    """Class scores of texts whose words have numbers in one dictionary (``flat``, ``counts``:
    hashed subword ids of its words): what the attention needs of each word, made once."""

    def __init__(self, p: dict, flat: np.ndarray, counts: np.ndarray):
        x = word_vectors(p["emb"], flat, counts)
        self.asked = np.concatenate([x, (x @ p["wq"]) * np.float32(DIM ** -0.5)], axis=1)
        self.seen = np.concatenate([x @ p["wk"], x @ p["wv"]], axis=1)
        self.bias = np.where(_CAUSAL, p["rel"][np.clip(_GAP, 0, 2 * STEP - 1)], np.float32(-1e9))
        self.wo, self.out = p["wo"], p["bias"]

    def of(self, tokens: Tokens, classes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, natural log of P(class | before)) of every token, windows at a time."""
        text, start, size = windows_of(tokens.first)
        for k in range(0, len(text), 256):
            w = slice(k, k + 256)
            word, _ = inputs_of(tokens.first, tokens.which, text[w], start[w])
            seen, asked = self.seen[word], self.asked[word[:, STEP:]]
            s = asked[:, :, DIM:] @ seen[:, :, :DIM].transpose(0, 2, 1)
            s += self.bias
            s[start[w] == 0, :, :STEP] = -1e9           # nothing before a text's start
            np.minimum(s, HIGH, out=s)
            np.exp(s, out=s)
            s /= (s @ _ONES)[:, :, None]
            y, real = targets_of(tokens, classes, text[w], start[w], size[w])
            at, place = np.nonzero(real)
            h = np.concatenate([asked[:, :, :DIM], s @ seen[:, :, DIM:]], axis=2)[at, place]
            logits = h @ self.wo
            logits += self.out
            np.minimum(logits, HIGH, out=logits)
            own = logits[np.arange(len(at)), y[at, place]].astype(np.float64)
            np.exp(logits, out=logits)
            yield text[w][at], own - np.log((logits @ _ONES_C).astype(np.float64))


def class_scores(p: dict, tokens: Tokens, flat: np.ndarray, counts: np.ndarray, classes: np.ndarray):
    """The scores of a slice by its own dictionary."""
    return Scores(p, flat, counts).of(tokens, classes)


# ------------------------------------------------------------------ on the cluster

def _occurrences(vocabulary):
    """Texts sorted by block → (block, word, training tokens, subword ids), once per block. The
    words are counted slice by slice and encoded when the block is complete."""
    def run(batches):
        encoder = bpe.encoder_of(vocabulary.value)
        block, held = None, []

        def flush():
            if not held:
                return None
            base = offsets_of(np.array([len(t.data) for t, _ in held]))[:-1]
            key, at, inv = np.unique(np.concatenate([t.key for t, _ in held]), return_index=True, return_inverse=True)
            n = np.bincount(inv, np.concatenate([c for _, c in held])).astype(np.int64)
            data = np.concatenate([t.data for t, _ in held])
            starts = np.concatenate([t.starts + b for (t, _), b in zip(held, base, strict=True)])[at]
            sizes = np.concatenate([t.sizes for t, _ in held])[at]
            flats, counts = [], []
            for k in range(0, len(key), 1 << 16):
                part = slice(k, k + (1 << 16))
                slot = encoder.lookup(key[part], data, starts[part], sizes[part])
                counts.append(encoder.counts[slot])
                flats.append(encoder.ids[ranges(encoder.starts[slot], counts[-1])])
            flat, size = np.concatenate(flats), np.concatenate(counts)
            body = pa.Array.from_buffers(pa.binary(), len(key), [
                None, pa.py_buffer(offsets_of(4 * size).astype(np.int32)), pa.py_buffer(flat.astype("<u4").view(np.uint8))])
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block)), pa.array(key.view(np.int64)), pa.array(n),
                                               pa.array(first_of(flat, size).astype(np.int32)), body],
                                              ["block", "word", "n", "sub", "subs"])

        for batch in batches:
            texts, blocks = Texts(batch.column("text")), batch.column("block").to_numpy()
            learns = batch.column("learns").to_numpy(zero_copy_only=False).astype(bool)
            cut = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                if lo == hi:
                    continue
                if blocks[lo] != block:
                    out = flush()
                    if out is not None:
                        yield out
                    block, held = blocks[lo], []
                i = lo
                while i < hi:
                    j = int(np.searchsorted(texts.offsets, texts.offsets[i] + 4 * SLICE_BYTES, side="right")) - 1
                    j = min(max(j, i + 1), hi)
                    t = Tokens(*texts.part(i, j))
                    if len(t.key):
                        own = np.repeat(learns[i:j], np.diff(t.first))
                        count = np.bincount(t.which, own, len(t.key))
                        t.hash = t.which = t.first = None          # only the distinct words are kept
                        held.append((t, count))
                    i = j
        out = flush()
        if out is not None:
            yield out
    return run


class Scorer:
    def __init__(self, params: dict, table: np.ndarray, class_mass: np.ndarray, n: int, v: int, ends: int):
        self.params, self.table, self.class_mass = params, table, class_mass
        self.total, self.ends = n + SMOOTH * (v + 1), ends


def _score(scorer):
    """One block: its texts and its words' counts and subwords → a row per text."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sc = scorer.value
        known = right.column("word").to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, count = known[order], right.column("count").to_numpy()[order]
        subs = Texts(right.column("subs"))
        flat, size = np.frombuffer(subs.data.tobytes(), dtype="<u4"), np.diff(subs.offsets) // 4
        flat = flat[ranges((subs.offsets[:-1] // 4)[order], size[order])].astype(np.int64)
        size = size[order]
        classes = np.where(count > 0, sc.table[first_of(flat, size)], 0) if len(count) else count
        log_class = np.log10(sc.class_mass / sc.total)
        base = np.log10((count + SMOOTH) / sc.total)
        inner = base - log_class[classes]
        end = np.log10((sc.ends + SMOOTH) / sc.total)
        scores = Scores(sc.params, hashed(flat), size)
        out: list[tuple] = []
        for batch in left.to_batches():
            texts = Texts(batch.column("text"))
            for i, j in texts.slices():
                t = Tokens(*texts.part(i, j))
                t.which = np.searchsorted(known, t.key)[t.which] if len(t.key) else t.which
                docs = j - i
                own = np.repeat(np.arange(docs), np.diff(t.first))
                sums = [np.bincount(own, x[t.which], docs) if len(own) else np.zeros(docs) for x in (base, inner, (count > 0).astype(np.float64))]
                model = sums[1] + end - log_class[1]
                for text, lp in scores.of(t, classes):
                    model += np.bincount(text, lp, docs) / np.log(10)
                out.append((np.diff(t.first) + 1, sums[2].astype(np.int64) + (sc.ends > 0), sums[0] + end, model))
        n, k, b, m = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
        return pa.table({"doc_id": left.column("doc_id"), "learns": left.column("learns"), "n_tokens": n.astype(np.int64),
                         "n_known": k.astype(np.int64), "base_score": b.astype(np.float64), "score": m.astype(np.float64)})
    return run


def train(docs: DataFrame, vocabulary, table: np.ndarray, params: dict) -> dict:
    """Parameters after ``ROUNDS`` of local steps on the texts of ``docs`` (text, lot)."""
    sc = docs.sparkSession.sparkContext
    of = sc.broadcast(table)
    for turn in range(ROUNDS):
        part = docs.where(F.col("lot") == turn).select("text")
        got = sum_arrays(part.mapInArrow(_train(vocabulary, sc.broadcast(params), of), "part int, sums binary"))
        if 0 in got:
            params = unpack(got[0][:-3] / got[0][-3])
    return params


def score(docs: DataFrame, learns: Column, vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, learns, n_tokens, n_known, train_tokens, base_score, score.
    ``learns``: which documents are learned from; ``vocabulary``: a shared ``bpe.Vocabulary``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), learns.alias("learns"))
    about = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.col("learns").cast("int")).alias("ends")).first()
    blocks = max(1, -(-(about["bytes"] or 0) // BLOCK_BYTES))
    ends = about["ends"] or 0
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    dealt = rows.repartition("block")
    found = dealt.sortWithinPartitions("block").mapInArrow(_occurrences(vocabulary), "block bigint, word bigint, n bigint, sub int, subs binary")
    same = Window.partitionBy("word")
    words = materialise(found.withColumn("count", F.sum("n").over(same))
                        .withColumn("one", F.row_number().over(same.orderBy("block")) == 1)
                        .select("block", "word", "count", "sub", "subs", "one"), "words")
    # one row per subword id at most
    mass, n, v = {}, ends, int(ends > 0)
    for r in (words.where("one and count > 0").groupBy("sub").agg(F.count(F.lit(1)).alias("v"), F.sum("count").alias("n"))
              .toLocalIterator()):
        mass[r["sub"]] = r["n"] + SMOOTH * r["v"]
        n, v = n + r["n"], v + r["v"]
    table = class_table(mass, vocabulary.value.size)
    class_mass = np.zeros(CLASSES)
    class_mass[:2] = SMOOTH, ends + SMOOTH
    for s, m in mass.items():
        class_mass[table[s]] += m
    params = train(rows.where("learns").select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).alias("lot")),
                   vocabulary, table, initial(class_mass))
    scorer = spark.sparkContext.broadcast(Scorer(params, table, np.maximum(class_mass, 1e-300), n, v, ends))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["learns"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
                           T.StructField("score", T.DoubleType())])
    counts = words.select("block", "word", "count", "subs")
    out = dealt.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_score(scorer), schema)
    return out.withColumn("train_tokens", F.lit(n).cast("bigint"))
