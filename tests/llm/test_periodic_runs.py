"""Periodic runs against a brute-force search, and the defined results of edge cases."""

import random
import re

import numpy as np
import pytest

from tessera.llm import common, periodic_runs
from tessera.llm.queries import _looped


def brute_runs(words):
    """Every maximal stretch of each period, the smallest period of equal stretches."""
    best = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q):
                best.setdefault((start, length), q)
            i = j
    return sorted((s, q, n) for (s, n), q in best.items())


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(words)
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return len(words), [(s, n, q) for s, q, n in runs], " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "é é é é é é é"]
    for _ in range(120):
        words = []
        while len(words) < rng.choice([5, 30, 90, 300]):
            period = [rng.choice("abC") for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 33]))]
            more = period * rng.choice([1, 2, 3, 4, 5, 6, 9])
            words += more[:len(more) - rng.randrange(len(period))]
            words += [rng.choice("abxyz") for _ in range(rng.randrange(3))]
        out.append(rng.choice([" ", "\t", " \n"]).join(words))
    out.append("w " * 5000)                                     # one word, every lag matches
    out.append(" ".join(f"w{i % 700}" for i in range(2900)))
    return out


def found(spark, rows, schema="doc_id bigint, text string"):
    got = periodic_runs.find_runs(spark.createDataFrame(rows, schema).repartition(3)).collect()
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]


@pytest.mark.parametrize("slice_bytes", [common.SLICE_BYTES, 700])
def test_runs_against_brute_force(monkeypatch, slice_bytes):
    monkeypatch.setattr(common.Texts.slices, "__defaults__", (slice_bytes,))
    rows = texts(slice_bytes)
    data = [("" if t is None else t).encode() for t in rows]
    offsets = common.offsets_of(np.array([len(b) for b in data]))
    for i in range(0, len(rows), 7):        # several texts in one slice
        j = min(i + 7, len(rows))
        lo, hi = int(offsets[i]), int(offsets[j])
        part = np.frombuffer(b"".join(data), dtype=np.uint8)[lo:hi]
        n_words, n_runs, runs, body, sizes = periodic_runs._slice(part, offsets[i:j + 1] - lo)
        at, cut = common.offsets_of(n_runs), common.offsets_of(sizes)
        for k in range(j - i):
            mine = [tuple(int(c[r]) for c in runs) for r in range(at[k], at[k + 1])]
            assert (int(n_words[k]), mine, bytes(body[cut[k]:cut[k + 1]]).decode()) == brute(rows[i + k])


def test_operator_and_edge_cases(spark, edge_docs, no_docs):
    rows = list(enumerate(texts(3)))
    rows += [(5, "a a a a a a"), (5, "a a a a a a"), (None, "b b b b b b b"), (None, None)]
    want = [(i, *brute(t)) for i, t in rows]
    key = repr
    assert sorted(found(spark, rows), key=key) == sorted(want, key=key)
    got = periodic_runs.find_runs(edge_docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert sorted((repr(r.doc_id), r.n_words, r.collapsed) for r in got.collect()) == sorted(
        (repr(r.doc_id), brute(r.text)[0], brute(r.text)[2]) for r in edge_docs.collect())
    assert periodic_runs.find_runs(no_docs).count() == 0


def test_strongest_ties(spark):
    runs = [(9, 8, 2), (3, 12, 3), (3, 8, 2), (20, 9, 3)]
    df = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start bigint, length bigint, period bigint>>")
    best = [r[0] for r in df.select(periodic_runs.strongest()).collect()]
    assert tuple(best[0]) == (9, 8, 2) and best[1] is None      # the array's order decides ties: find_runs sorts it


def test_longer_than_a_batch(spark):
    """One text beyond a batch's bytes next to short ones: 1.6 million words, period 5."""
    long = "alpha beta gamma delta eps " * 320_000
    assert len(long) > common.BATCH_BYTES
    df = spark.createDataFrame([(1, "a b"), (2, long + "end"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(df.coalesce(1)).collect()}
    assert [tuple(x) for x in got[2].runs] == [(0, 1_600_000, 5)]
    assert got[2].collapsed == "alpha beta gamma delta eps end" and got[1].collapsed == "a b" and got[3].n_words == 0


def test_looped_texts(spark):
    from zlib import crc32
    rows = [(i, " ".join(f"w{k}" for k in range(i % 60))) for i in range(300)] + [(7, None), (None, "x y")]
    got = {(r.doc_id, (r.text or "")[:0]): r.text for r in _looped(spark.createDataFrame(rows, "doc_id bigint, text string")).where(
        "doc_id is not null and text is not null").collect()}
    for i, t in rows[:300]:
        words, h = t.split(), crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
        assert got[i, ""].split() == words
