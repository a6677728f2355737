"""BPE, licence scan, language, quality and language-model operators, and the pipeline."""

import base64
import math
import random
import re
import string
import struct
from collections import Counter
from types import SimpleNamespace
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, language_id, license_scan, lm_score, quality, queries
from tessera.llm.license_scan import Template

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference_encoding():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    with open(queries.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(queries.vocabulary_path()))


def test_bpe_edge_cases_and_round_trip(spark, edge_docs, no_docs, reference_encoding):
    shared = bpe.share(edge_docs, queries.vocabulary_path())
    out = bpe.decode(bpe.encode(edge_docs, shared), shared)
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in out.collect())
    want = Counter()
    for r in edge_docs.collect():
        ids = reference_encoding.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), struct.pack(f"<{len(ids)}I", *ids), (r["text"] or "").encode()] += 1
    assert got == want
    assert bpe.decode(bpe.encode(no_docs, shared), shared).count() == 0


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    ids, n = encoder.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    at = np.concatenate([[0], np.cumsum(n)])
    return [ids[at[i]:at[i + 1]].tolist() for i in range(len(raw))]


def test_bpe_random_texts(vocabulary, reference_encoding, monkeypatch):
    rng = random.Random(9)
    parts = [*"abcdest lmrv''  \n\t.,!?é5½　ß漢😀\x1c\x85", "'s", "'re", "'ll", "'ve", "  ", "\r\n", "'d", "'t", "'m", " '", "''"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["a" * 5000 + " b", "ab" * 3000, "  " * 3000, "'S it's", "<|endoftext|>"]
    want = [reference_encoding.encode_ordinary(t) for t in texts]
    assert encoded(bpe.Encoder(vocabulary), texts) == want
    monkeypatch.setattr(bpe, "LONG", 4)       # the heap takes over
    monkeypatch.setattr(bpe, "CACHE", 10)     # the cache starts again and again
    assert encoded(bpe.Encoder(vocabulary), texts[:400]) == want[:400]


def test_licences(spark, edge_docs, no_docs):
    texts = ["Released under the MIT License. mit-license", "gnu GENERAL public\nlicense, version 3 of the General Public License",
             "general license public", "apache license mit licenses", "Redistribution and use in source and binary forms, with",
             "Licensed under CC BY-NC 4.0.", None, "", "license " * 300]
    df = spark.createDataFrame([(i, t, "junk", "junk") for i, t in enumerate(texts)], "doc_id bigint, text string, row string, labels string")
    got = {r["doc_id"]: r for r in license_scan.label_files(df).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["labels"]) == (2, 3, 5, ["mit"])
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 1, 8, ["gpl"])
    assert got[1]["labels"] == ["gpl", "gpl-3"] and got[1]["score"] == 1.0
    assert got[2]["n_base"] == 0 and got[2]["labels"] == [] and got[2]["first_word"] is None and got[2]["score"] == 0
    assert got[3]["labels"] == ["apache"] and got[3]["n_words"] == 4
    assert got[4]["labels"] == ["bsd"] and got[4]["base_labels"] == [] and 0 < got[4]["score"] < 1
    assert got[5]["labels"] == ["cc-by-nc"]
    assert got[6]["n_words"] == got[7]["n_words"] == 0 and got[8]["n_words"] == 300
    assert license_scan.label_files(edge_docs).count() == edge_docs.count()
    assert license_scan.label_files(no_docs).count() == 0


def test_licence_rare_word_is_the_key_phrases(spark):
    df = spark.createDataFrame([(i, "common rare" if i == 0 else "common") for i in range(9)], "doc_id bigint, text string")
    files, matches = license_scan.scan(df, templates=[Template("x", "a common rare b", "common rare")])
    assert [(r["label"], r["start"], r["end"]) for r in matches.collect()] == [("x", 0, 2)] and files.count() == 9


def learner(spark, n=400):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["river", "stone", "and", "light", "of"]) for _ in range(40)) + "."
    bad = lambda: " ".join([rng.choice(["buy", "now"]).upper() + "!!"] * 30)
    rows = [(i, good() if i % 2 else bad(), "junk") for i in range(n)]
    labels = [(i, i % 2, 0) for i in range(n)] + [(0, None, 0), (None, 1, 0), (10**6, 1, 0), (1, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, score string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_quality_learns_and_keeps_columns(spark, edge_docs, no_docs):
    docs, labels = learner(spark)
    model = quality.fit(docs, labels.where("doc_id < 300 or doc_id is null"))
    got = quality.score(docs, model, carry=tuple(docs.columns))
    rows = got.collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in rows if r["doc_id"] >= 300)
    assert got.select("row.*").columns == docs.columns
    edge = quality.score(edge_docs, model).collect()
    assert len(edge) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in edge)
    assert quality.score(no_docs, model).count() == 0
    assert quality.fit(docs, labels.where("false")).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5
    one = quality.fit(docs, labels.where("quality = 1"))
    assert all(r["score"] > 0.9 for r in quality.score(docs, one).collect())
    assert quality.fit(no_docs, labels).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5


def test_quality_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0)).astype(float)
    m = quality.AdditiveModel(x[:3000], y[:3000])
    assert m.pairs[0] == (0, 2)
    assert ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
    logit = np.full(5, m.intercept)
    b = m.bins(x[:5])
    for k, t in enumerate(m.tables):
        logit += [t[i] for i in b[:, k]]
    for t, (i, j) in zip(m.pair_tables, m.pairs, strict=True):
        logit += [t[m.coarse[i][u], m.coarse[j][v]] for u, v in zip(b[:, i], b[:, j], strict=True)]
    assert np.allclose(m.score(x[:5]), 1 / (1 + np.exp(-logit)))


def byte_grams(text):
    """Distinct n-grams (n = 2, 3, 4) of the lower-cased bytes, other bytes than letters as blanks."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode())
    return {raw[i:i + n] for n in (2, 3, 4) for i in range(len(raw) - n + 1)}


def as_bytes(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)


def test_presence_of_ngrams():
    texts = ["aB1c", "", "é", "xyz", "ab", "ab ab é ab!ab", "Ünï ünï", "z", "the quick brown fox " * 300]
    marks = ["ab1cd", "é ab", "the lazy fox", "xyz"]
    data, offsets = as_bytes(marks)
    codes = language_id.gram_codes(data, offsets)
    for level, n in enumerate((2, 3, 4)):
        assert len(np.unique(codes[level][0])) == len({g for m in marks for g in byte_grams(m) if len(g) == n})
    grams = language_id.Grams([c for c, _ in codes])
    known = {g for m in marks for g in byte_grams(m)}
    assert grams.size == len(known)
    p, own = grams.presence(*as_bytes(texts)), grams.presence(data, offsets)
    for i, t in enumerate(texts):
        assert p[i].sum() == len(byte_grams(t) & known)
        for j, m in enumerate(marks):
            assert p[i] @ own[j] == len(byte_grams(t) & byte_grams(m))      # the kernel, exactly


def test_kernel_ridge_against_brute_force(spark):
    """Landmark map and solution from Python sets and one dense system."""
    rng = random.Random(8)
    make = {"": "abcd", "bb": "cdwx", "cc": "éèabw"}
    rows = [(i, " ".join("".join(rng.choices(make[k], k=rng.randrange(2, 9))) for _ in range(rng.randrange(1, 30))), k) for i in range(40) for k in make]
    rows += rows[:9]                                                        # repeated rows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    model = language_id.fit(docs, landmarks=12)
    assert model.langs == ["", "bb", "cc"]                                  # an empty string is a language
    marks = {r.tobytes(): r for r in np.round(model.landmarks.T * np.sqrt((model.landmarks > 0).sum(axis=0))[:, None]).astype(int)}
    assert len(marks) == 12
    # landmarks as sets: read back from the texts whose presence they are
    presence = {t: model.grams.presence(*as_bytes([t]))[0].astype(int) for _, t, _ in rows}
    chosen = [next(t for t in presence if set(np.flatnonzero(presence[t])) == set(np.flatnonzero(m))) for m in model.landmarks.T > 0]
    known = set().union(*map(byte_grams, chosen))
    k = np.array([[len(byte_grams(t) & byte_grams(c)) / np.sqrt(len(byte_grams(c)) * max(1, len(byte_grams(t) & known))) for c in chosen] for _, t, _ in rows])
    lang = np.array([model.langs.index(x) for *_, x in rows])
    weight = 1 / np.bincount(lang)[lang]
    inner = np.array([[len(byte_grams(a) & byte_grams(b)) / np.sqrt(len(byte_grams(a)) * len(byte_grams(b))) for b in chosen] for a in chosen])
    y = np.where(lang[:, None] == np.arange(3), 1, -0.5)
    want = np.linalg.solve((k * weight[:, None]).T @ k + language_id.RIDGE * inner + 1e-8 * np.eye(12), (k * weight[:, None]).T @ y)
    values = k @ want
    assert np.allclose(model.values(np.array([presence[t] for _, t, _ in rows], dtype=np.float32)), values, atol=2e-3)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language_id.predict(docs, model).collect()}
    for (i, t, x), v in zip(rows, values):
        best = model.langs[int(v.argmax())]
        if np.sort(v)[-1] - np.sort(v)[-2] > 1e-2:
            assert got[i, best] == pytest.approx(min(max((1 + v.max()) / 2, 0), 1), abs=2e-3)


def test_language_of_a_text_longer_than_a_batch(spark):
    """A text of ten million bytes keeps its language: the kernel counts the landmarks' n-grams only."""
    rng = random.Random(9)
    make = {"aa": "abcdefgh", "bb": "abcdwxyz"}
    rows = [(i, " ".join("".join(rng.choices(make[k], k=6)) for _ in range(40)), k) for i in range(60) for k in make]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    block = " ".join("".join(rng.choices(make["bb"], k=6)) for _ in range(30_000))
    long = spark.createDataFrame([(1, " ".join([block] * 48)), (2, rows[0][1])], "doc_id bigint, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(long, model).collect()}
    assert len(block) * 48 > 10_000_000 and got == {1: "bb", 2: "aa"}


def test_language(spark, edge_docs, no_docs):
    rng = random.Random(6)
    make = {"aa": "abcd", "bb": "wxyz", "cc": "éèàù"}
    rows = [(i, " ".join("".join(rng.choices(make[k], k=5)) for _ in range(20)), k, "junk") for i in range(150) for k in make]
    rows += [(900, None, "aa", ""), (901, "12 34 !", "bb", ""), (902, "abcd", None, ""), (903, "", "cc", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, bits string")
    model = language_id.fit(docs.where("doc_id < 100 or doc_id >= 900"))
    got = language_id.predict(docs.drop("lang"), model).collect()
    truth = {(r[0], r[2]) for r in rows if r[0] < 900}
    assert Counter((r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] < 900) == Counter({t: 1 for t in truth})
    late = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] >= 900}
    assert late[900] == late[901] == late[903] == ("und", 0.0) and late[902][0] == "aa"
    edge = language_id.predict(edge_docs, model).collect()
    assert len(edge) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in edge)
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.predict(docs, language_id.fit(docs.where("false"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_lm_base_scores(spark, edge_docs, no_docs):
    shared = bpe.share(edge_docs, queries.vocabulary_path())
    learns = quality.fold(F.col("doc_id"), 10) != 0
    got = lm_score.score(edge_docs, learns, shared).collect()
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    train = [words(t) for i, t in rows if crc32(b"" if i is None else str(i).encode()) % 10]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()) + len(train), len(count) + 1
    p = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    want = Counter()
    for i, t in rows:
        w = words(t)
        want[i, len(w) + 1, sum(1 for x in w if count[x]) + 1, n, round(sum(p(count[x]) for x in w) + p(len(train)), 6)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm_score.score(no_docs, learns, shared).count() == 0
    none = lm_score.score(edge_docs, F.lit(False), shared).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)


def test_lm_windows_score_each_token_once(vocabulary):
    texts = ["", " ".join(f"w{i % 7}" for i in range(150)), "one two", " ".join("x" * (i % 5 + 1) for i in range(31))]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    t = lm_score.Tokens(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    flat, counts = t.subwords(bpe.Encoder(vocabulary))
    classes = 2 + np.arange(len(counts)) % 9
    params = lm_score.initial(np.ones(lm_score.CLASSES))
    params["wo"] *= 20
    got = list(lm_score.class_scores(params, t, lm_score.hashed(flat), counts, classes))
    at, lp = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
    assert np.bincount(at, minlength=4).tolist() == [1, 151, 3, 32]
    # the same windows, one token at a time
    vec = lm_score.word_vectors(params["emb"], lm_score.hashed(flat), counts).astype(float)
    k = 0
    for d in range(4):
        own = t.which[t.first[d]:t.first[d + 1]].tolist()
        inputs = [-1, *own]
        for i in range(len(inputs)):
            lo = max(0, i // lm_score.STEP * lm_score.STEP - lm_score.STEP)
            x = vec[inputs[lo:i + 1]]
            s = (x @ params["wk"]) @ (x[-1] @ params["wq"]) / math.sqrt(lm_score.DIM) + params["rel"][np.arange(len(x))[::-1]]
            a = np.exp(s - s.max())
            logits = np.concatenate([x[-1], (a / a.sum()) @ (x @ params["wv"])]) @ params["wo"] + params["bias"]
            y = classes[own[i]] if i < len(own) else 1
            assert abs(logits[y] - np.log(np.exp(logits).sum()) - lp[k]) < 1e-3
            k += 1


def test_lm_trains_on_every_window(vocabulary):
    texts = ["one two three", "", "word " * 500] + [f"short text {i}" for i in range(40)]
    params = lm_score.initial(np.ones(lm_score.CLASSES))
    held = lambda x: SimpleNamespace(value=x)
    run = lm_score._train(held(vocabulary), held(params), held(np.full(vocabulary.size, 2)))
    batch = pa.RecordBatch.from_pydict({"text": texts, "lot": list(range(len(texts)))})
    windows, _, tokens = np.frombuffer(next(run([batch])).column("sums")[0].as_py())[-3:]
    sizes = [len(t.split()) + 1 for t in texts]
    assert tokens == sum(sizes)
    assert windows == sum(-(-n // lm_score.STEP) for n in sizes)


def test_lm_gradients_are_right():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm_score.initial(np.ones(lm_score.CLASSES)).items()}
    p["wo"] = rng.standard_normal(p["wo"].shape) * 0.3
    x = rng.standard_normal((2, 2 * lm_score.STEP, lm_score.DIM))
    inside = np.ones((2, 2 * lm_score.STEP), dtype=bool)
    inside[0, :lm_score.STEP] = False
    y, real = rng.integers(0, lm_score.CLASSES, (2, lm_score.STEP)), np.ones((2, lm_score.STEP), dtype=bool)
    g, dx, _ = lm_score.gradients(p, x, inside, y, real)

    def loss():
        z, _ = lm_score.forward(p, x, inside)
        z = z - z.max(axis=2, keepdims=True)
        return -np.take_along_axis(z - np.log(np.exp(z).sum(axis=2, keepdims=True)), y[:, :, None], 2).mean()
    for array, gradient in [*((p[k], g[k]) for k in ("wo", "bias", "rel", "wq", "wk", "wv")), (x, dx)]:
        at = tuple(rng.integers(0, s) for s in array.shape)
        old = array[at]
        array[at] = old + 1e-4
        up = loss()
        array[at] = old - 1e-4
        down = loss()
        array[at] = old
        assert abs((up - down) / 2e-4 - gradient[at]) < 1e-5


def test_lm_beats_its_base_on_held_out_texts(spark):
    rng = random.Random(2)
    topics = [[f"{c}{i}" for i in range(30)] for c in "pqrst"]
    rows = [(i, " ".join(rng.choices(topics[i % 5], k=60))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    shared = bpe.share(docs, queries.vocabulary_path())
    r = lm_score.score(docs, quality.fold(F.col("doc_id"), 10) != 0, shared).where("not learns").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SF)
        res = con.execute(sql)
        columns = [d[0] for d in res.description]
        assert sorted(columns) == sorted(got.columns)
        assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in got.select(*columns).collect()), name


def test_pipeline_stages(spark, edge_docs, no_docs, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "decontamination", "tokens"]
    for docs in (edge_docs, no_docs):
        before = docs
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{docs is no_docs}-{name}")
            stage(spark, before, SF).write.parquet(path)
            after = spark.read.parquet(path)
            assert after.count() <= before.count()
            if name != "tokens":
                assert after.dtypes == docs.dtypes
            before = after
        assert {"doc_id", "n_tokens", "ids_sha256"} <= set(before.columns)


def test_pipeline_runs_and_keeps_clean_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(docs, "doc_id").select("doc_id").collect()
    assert len(kept & {r["doc_id"] for r in good}) > 0.7 * len(good)
    assert out.where("ids_sha256 is null or decoded_sha256 is null").count() == 0
