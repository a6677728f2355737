"""Suffix-array dedup, Jaccard join and decontamination against brute force."""

import random
import re
import string

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.llm import decontaminate, jaccard_join, suffix_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def removed(rows):
    """(doc_id, bytes) → kept bytes, removed, spans of each row."""
    big = 1 << 62
    least = {}
    for i, b in rows:
        for s in range(len(b) - 49):
            w = b[s:s + 50]
            least[w] = min(least.get(w, big), big - 1 if i is None else i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if least[b[s:s + 50]] < (big - 1 if i is None else i):
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i is None, i or 0, kept, sum(gone), sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))))
    return sorted(out)


def found(df, **more):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["kept"]), r["n_removed"], r["n_spans"])
                  for r in suffix_dedup.remove_repeats(df, **more).collect())


def test_repeats_edge_cases(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in edge_docs.collect()]
    assert found(edge_docs) == removed(rows)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_repeats_random_against_brute_force(spark):
    rng = random.Random(11)
    stock = ["".join(rng.choice("abé \n") for _ in range(rng.randrange(20, 200))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(stock) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(0, 80)))
                 for _ in range(rng.randrange(0, 6))]
        rows.append((rng.randrange(120), "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df) == removed([(i, t.encode()) for i, t in rows])


def test_repeats_distinct_zones_of_a_hot_gram(spark):
    # every text has the same 16-gram where its zone is sampled, and nothing else twice
    rng = np.random.default_rng(7)
    grams = rng.integers(97, 123, (1 << 20, 16), dtype=np.uint8)
    halves = grams.reshape(-1).view("<u8").reshape(-1, 2)
    hot = grams[np.argmin(suffix_dedup.refine(halves[:, 0], halves[:, 1]) * suffix_dedup._C3)]
    n = 300_000
    texts = np.concatenate([rng.integers(97, 123, (n, 34), dtype=np.uint8), np.tile(hot, (n, 1)), rng.integers(97, 123, (n, 34), dtype=np.uint8)], axis=1)
    df = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(n), "text": [t.tobytes().decode() for t in texts]}))
    assert suffix_dedup.remove_repeats(df).agg(F.sum("n_removed")).first()[0] == 0


def test_repeats_as_text_keeps_rows_and_columns(edge_docs):
    out = suffix_dedup.remove_repeats(edge_docs, carry=tuple(edge_docs.columns), as_text=True)
    got = out.select("kept", "row.*").collect()
    assert len(got) == edge_docs.count() and all(r["settled"] == "junk" for r in got)


def jaccard_truth(rows):
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k:k + 5]) for k in range(len(w) - 4)])))
    links, pairs = [0] * len(sets), []
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and len(x & y) / len(x | y) >= 0.8:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    from test_graph_operators import roots  # noqa: PLC0415
    find = roots(pairs)
    low = {}
    for a, r in find.items():
        if sets[a][0] is not None:
            low[r] = min(low.get(r, 10**9), sets[a][0])
    return sorted([(s[0] is None, s[0] or 0, links[a], low.get(find[a]) if a in find else s[0]) for a, s in enumerate(sets)], key=str)


def joined(df, **more):
    return sorted([(r["doc_id"] is None, r["doc_id"] or 0, r["n_links"], r["component_id"]) for r in jaccard_join.similar(df, **more).collect()], key=str)


def test_jaccard_edge_cases(edge_docs, no_docs):
    assert joined(edge_docs) == jaccard_truth([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert jaccard_join.similar(no_docs).count() == 0


def test_jaccard_hot_groups_against_brute_force(spark, monkeypatch):
    # small limits: buckets are split over several levels, groups of copies go in several cells
    monkeypatch.setattr(jaccard_join, "SMALL", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    line = lambda n: [rng.choice(vocab) for _ in range(n)]
    common, near, rows = line(30), line(120), []
    for i in range(60):
        rows.append((i, " ".join(common + line(60))))                    # a passage in many texts
    for i in range(60, 130):
        w = list(near)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))                                     # near copies
    rows += [(i, " ".join(near)) for i in range(130, 150)] + [(i, " ".join(line(rng.randrange(1, 50)))) for i in range(150, 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert joined(df, recall=0.99999) == jaccard_truth(rows)


def test_jaccard_template_pages_are_never_lost(spark):
    # more than SMALL pages a template, all but one place the same: first-level buckets have the same members
    rng = random.Random(8)
    n, rows = jaccard_join.SMALL + 6, []
    for t in range(24):
        page = [f"t{t}w{rng.randrange(10**6)}" for _ in range(120)]
        rows += [(t * n + i, " ".join([*page[:60], f"number{i}", *page[60:]])) for i in range(n)]
    got = joined(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert got == sorted([(False, i, n - 1, i // n * n) for i, _ in rows], key=str)


def test_keep_one(edge_docs, no_docs):
    got = jaccard_join.keep_one(edge_docs).collect()
    assert got[0].asDict().keys() == edge_docs.first().asDict().keys()
    sets = [tuple(words(r["text"])) for r in got if r["doc_id"] is not None]
    full = [s for s in sets if s]
    assert len(full) == len(set(full))                        # no exact copies are left
    assert sum(1 for s in sets if not s) == sum(1 for r in edge_docs.collect() if r["doc_id"] is not None and not words(r["text"]))
    assert jaccard_join.keep_one(no_docs).count() == 0
    unique = edge_docs.where("doc_id > 9 and doc_id is not null")
    assert {r["doc_id"] for r in jaccard_join.keep_one(unique).collect()} <= {r["doc_id"] for r in unique.collect()}


def windows(rows, size=10):
    out = {}
    for i, t in rows:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            out.setdefault(tuple(w[k:k + n]), set()).add(None if i is None else str(i))
    return out


def hits(rows, items):
    win = windows(items)
    out = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in win:
                    hit.update(range(k, k + n))
                    names |= {x for x in win[tuple(w[k:k + n])] if x is not None}
        out.append((i is None, i or 0, len(w), sorted(hit), sorted(names)))
    return sorted(out)


def test_decontamination_against_brute_force(spark, edge_docs, no_docs):
    docs = edge_docs.collect()
    passage = next(r["text"] for r in docs if r["doc_id"] == 9 and "shared" in r["text"])
    items = [(1, passage), (2, " ".join(passage.split()[5:20])), (2, " ".join(passage.split()[5:20])), (3, "mit license"),
             (4, "été"), (5, None), (6, ""), (7, "--"), (None, "alpha beta"), (8, "x1 no"), (8, "the of the of the of the of the of the")]
    bench = spark.createDataFrame([(i, t, "junk") for i, t in items], "item_id bigint, text string, id string")
    rows = [(r["doc_id"], r["text"]) for r in docs]
    for block_bytes in (1 << 20, 60):      # one block of items, several
        got = decontaminate.find_contamination(edge_docs, bench, carry=tuple(edge_docs.columns), block_bytes=block_bytes)
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["hit_words"], r["items"]) for r in got.collect()) == hits(rows, items)
        assert got.select("row.*").columns == edge_docs.columns
    assert decontaminate.find_contamination(no_docs, bench).count() == 0
    none = decontaminate.find_contamination(edge_docs, bench.where("false")).collect()
    assert len(none) == len(rows) and not any(r["hit_words"] for r in none)


def test_rows_without_or_with_one_id_meet_their_class_once(spark):
    """Thousands of texts without an id, and as many with one and the same: each class is read
    once, and near copies among them link."""
    import random

    from tessera.llm import jaccard_join
    rng = random.Random(11)
    base = [[f"w{rng.randrange(5000)}" for _ in range(60)] for _ in range(400)]

    def near(words, k):
        out = list(words)
        out[k] = "changed"
        return " ".join(out)
    rows = [(None, near(w, 0)) for w in base] + [(None, near(w, 59)) for w in base] + [(7, near(w, 1)) for w in base] + [(7, " ".join(w)) for w in base]
    rows += [(10_000 + i, " ".join(w)) for i, w in enumerate(base[:50])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = jaccard_join.similar(docs).collect()
    assert len(got) == len(rows)
    # the four texts of a base are near copies of one another; the last is there twice for 50 of them
    by = {}
    for r in got:
        by.setdefault(r["n_links"], 0)
        by[r["n_links"]] += 1
    assert set(by) <= {3, 4} and by[4] == 50 * 5 and by[3] == 350 * 4
