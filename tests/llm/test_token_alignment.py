"""Token alignment against whole-text encoding by the two libraries, and corpus counts by hand."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tessera.llm import token_alignment as ta
from tessera.llm.common import BATCH_BYTES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WIDTH = 32000


@pytest.fixture(scope="module")
def plain():
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    alphabet = ta.byte_alphabet()
    return a, b, {i: bytes(alphabet[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}


def whole(plain, text):
    """(a ids, b ids, groups, links) of a text encoded in one piece; ends by decoded bytes only."""
    a, b, a_bytes = plain
    if not text:
        return [], [], [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    jds = b.encode(text)
    parts_a = [a_bytes[i] for i in ids]
    parts_b = [bytes([int(b.id_to_piece(j)[3:-1], 16)]) if b.is_byte(j) else b.id_to_piece(j).replace("▁", " ").encode() for j in jds]
    data = (" " + text).encode()
    if b"".join(parts_a) != data or b"".join(parts_b) != data:
        return [], [], [], []

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out
    sa, sb = spans(parts_a), spans(parts_b)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, at = [], 0
    for c in cuts:
        groups.append(([i for i, (lo, hi) in zip(ids, sa) if at <= lo and hi <= c], [j for j, (lo, hi) in zip(jds, sb) if at <= lo and hi <= c]))
        at = c
    links = [(i, j) for i, (l1, h1) in zip(ids, sa) for j, (l2, h2) in zip(jds, sb) if l1 < h2 and l2 < h1]
    return ids, jds, groups, links


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def expected(plain, rows):
    done = [(i, *whole(plain, t)) for i, t in rows]
    count = Counter(x for *_, links in done for x in links)
    highest = {}
    for (_, j), n in count.items():
        highest[j] = max(highest.get(j, 0), n)
    return sorted(((i, len(a), len(b), len(g), len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(written(g).encode()).hexdigest() if a else "") for i, a, b, g, links in done), key=repr)


def made(spark, rows, **more):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return ta.align(df, ta.share(spark, A_PATH, B_PATH), WIDTH, **more)


def result(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()), key=repr)


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", "Hello", "wörld", "漢字", "🎉", "👩‍👩‍👧", "x1", "don't", "1234", "<|endoftext|>", "</s>", "<0x41>", "ﬁ", "é", "​",
             "Ünïcödé", "ñandú", "...", "—", "\x07", "a" * 30, "﻿", "한국어", "Привет", "́"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", " \n ", "", " ", "   ", "　", "\r\n", "   ", " ", "\x1c", "\u0085 ", "\x0b"]
    return ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randrange(1, 25))) if rng.random() < .9
            else rng.choice(gaps) + rng.choice(parts) for _ in range(n)] + gaps + parts + ["▁", "a ▁b", " a", "a ", " ", "   ", "\n ", " \n"]


def test_units_are_cut_where_both_tokenizers_cut(plain):
    """Encoding by units equals encoding whole texts, for texts full of odd spaces and characters."""
    aligner = ta.Aligner(ta.Files(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read()))
    for text in odd_texts(1, 800):
        assert "".join(ta.UNIT.findall(" " + text)) == " " + text
        block = ta.Block(aligner, [text])
        a, b, groups, links = whole(plain, text)
        units = [block.units[u] for u in block.rows[0].tolist()]
        got = {c: ta.joined(u[c] for u in units)[0].tolist() for c in (ta.A, ta.B, ta.LINKS)}
        assert got[ta.A] == a and got[ta.B] == b, repr(text)
        assert b";".join(u[ta.TEXT] for u in units).decode() == written(groups)
        assert sorted(got[ta.LINKS]) == sorted(i * WIDTH + j for i, j in links)


def test_against_brute_force(spark, plain):
    rows = list(enumerate([None, "", *odd_texts(2, 150)])) + [(3, "the same text"), (3, "the same text"), (None, "no id"), (None, None)]
    assert result(made(spark, rows)) == expected(plain, rows)


def test_edge_docs(spark, plain, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = made(spark, edge_docs)
    assert result(got) == expected(plain, rows)
    assert made(spark, no_docs).count() == 0
    text = {(r.doc_id, r.groups) for r in made(spark, edge_docs, digest=False).collect()}
    assert text == {(i, written(whole(plain, t)[2])) for i, t in rows}


def test_spans(spark, plain):
    rows = list(enumerate([None, "a ▁b", *odd_texts(4, 40)]))
    got = {r.doc_id: r for r in ta.token_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), ta.share(spark, A_PATH, B_PATH)).collect()}
    for i, t in rows:
        a, b, groups, _ = whole(plain, t)
        assert got[i].a_ids == a and got[i].b_ids == b and len(got[i].group_ends) == len(groups)
        if a:
            data, at = (" " + t).encode(), 0
            for k, e in zip(a, got[i].a_ends):
                assert data[at:e] == plain[2][k]
                at = e
            assert got[i].group_ends[-1] == got[i].b_ends[-1] == len(data)


def test_longer_than_a_batch(spark, plain):
    line = "A line of plain words, again and again: naïve façade. "
    long = line * (BATCH_BYTES // len(line) + 5)
    got = {r.doc_id: r for r in made(spark, [(1, long), (2, line), (3, "zebra")]).collect()}
    one = whole(plain, line.strip())
    times = BATCH_BYTES // len(line) + 5
    assert got[1].n_a == len(one[0]) * times + 1 and got[1].n_links == len(one[3]) * times + 1    # and the last space
    assert got[2].n_links == len(one[3]) + 1 and got[3].count_sum >= got[3].n_links
