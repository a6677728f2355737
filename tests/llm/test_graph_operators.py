"""URL filter, embedding near-duplicates and connected components."""

import math
import random

import pytest

from tessera.llm import embed_dedup, url_filter
from tessera.llm.components import connected_components
from tessera.llm.queries import URL_RULES
from tessera.llm.url_filter import Rule


def roots(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


def test_components_against_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)]                 # a chain
    pairs += [(5000, i) for i in range(2000, 2100)]                    # a hub
    pairs += [(7, 7), (1000, 1001)]                                    # a loop, a repeat
    want = roots([p for p in pairs if p[0] != p[1]])
    got = connected_components(spark.createDataFrame([*pairs, (None, 3)], "src bigint, dst bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == want
    assert len(got) == len(want)


def test_components_empty(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def page(i, url, html="<html></html>"):
    return (i, url, html, "junk", "junk")


PAGES = "page_id bigint, url string, html string, host string, rule string"


def test_url_rules_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    pages = spark.createDataFrame([
        page(1, "http://WWW.Example.com/en/a?x=1#top"),
        page(2, "https://blog.example.com/en/b"),
        page(3, "https://b.org/x", link.format("https://blog.example.com/en/b")),          # alias of a blocked page
        page(4, "https://c.org/y", '<META http-equiv="refresh" content="0; url=/z">'),      # forwards to 5
        page(5, "https://c.org/z", "<link href='//b.org/x' rel='canonical'>"),              # alias of an alias
        page(6, "https://d.org/q", link.format("https://www.example.com/en/a?x=1")),        # alias of an allowed page
        page(7, "https://www.example.com/en/z", link.format("https://n.net/es/1")),         # allowed itself
        page(8, "https://e.org/r", link.format("https://www.example.com/en/z")),            # component with an allow
        page(9, None), page(10, "no scheme"), page(11, ""), page(12, "https://n.net/es/1", None),
        page(13, "https://n.network/es/"), page(13, "https://n.network/es/"), page(None, "http://x.com"),
    ], PAGES)
    got = {(r["page_id"], r["host"]): r for r in url_filter.judge(pages, URL_RULES).collect()}
    verdict = {k[0]: (v["rule"], v["verdict"]) for k, v in got.items()}
    assert verdict[1] == ("www.example.com/en/", "allow") and got[(1, "www.example.com")]["path"] == "/en/a"
    assert verdict[2] == ("example.com/en/", "block")
    assert verdict[3] == verdict[4] == verdict[5] == (None, "block")
    assert verdict[6] == (None, "allow") and verdict[7][1] == "allow" and verdict[8] == (None, "allow")
    assert verdict[9] == verdict[10] == verdict[11] == (None, "allow") and got[(9, "")]["path"] == ""
    assert verdict[12] == ("net/es/", "block") and verdict[13] == (None, "allow")
    assert verdict[None] == (None, "allow")           # no path: com/ does not fit
    assert url_filter.judge(pages, URL_RULES).count() == 15


def test_url_many_rules_agree_with_compiled(spark, monkeypatch):
    rng = random.Random(3)
    pages = spark.createDataFrame([page(i, f"http://{rng.choice('abc')}.{rng.choice('xy')}.com/{rng.choice(['', 'p/', 'p/q'])}")
                                   for i in range(60)], PAGES)
    rules = [Rule(a, h, p) for a, h, p in [("allow", "com", "/"), ("block", "x.com", "/p/"), ("allow", "a.x.com", "/p/q"), ("block", "b.y.com", "/")]]
    one = sorted(map(tuple, url_filter.judge(pages, rules).select("page_id", "rule", "verdict").collect()))
    monkeypatch.setattr(url_filter, "COMPILED_RULES", 0)
    assert sorted(map(tuple, url_filter.judge(pages, rules).select("page_id", "rule", "verdict").collect())) == one


def test_url_redirect_table_and_empty(spark):
    pages = spark.createDataFrame([page(1, "http://a.org/1"), page(2, "http://b.org/2")], PAGES)
    hops = spark.createDataFrame([("http://a.org/1", "http://q.net/fr/9"), (None, "http://b.org/2")], "src string, dst string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, URL_RULES, redirects=hops).collect()}
    assert got == {1: "block", 2: "allow"}
    assert url_filter.judge(pages.where("false"), URL_RULES).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)      # several cells per bucket
    rng = random.Random(2)
    base = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)]
    for i in range(60, 140):
        v = base[i % 3]
        rows.append((i, [x + rng.gauss(0, 0.08) for x in v]))
    rows += [(200 + i, base[5]) for i in range(20)]                     # copies
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16),
             (305, [float("inf")] + [1.0] * 15), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (308, [x * 1e-3 for x in base[7]]),
             (7, base[7]), (None, base[8])]
    df = spark.createDataFrame([(i, v, 0, "junk") for i, v in rows], "vec_id bigint, embedding array<float>, label int, vec string").repartition(4)
    data = [(r["vec_id"], r["embedding"]) for r in df.collect()]

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v] if n else None
    units = [unit(v) for _, v in data]
    links, pairs = [0] * len(data), []
    for i in range(len(data)):
        for j in range(i):
            if units[i] and units[j] and len(units[i]) == len(units[j]) and sum(a * b for a, b in zip(units[i], units[j], strict=True)) >= 0.95:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    find = roots(pairs)
    low = {}
    for i, r in find.items():
        if data[i][0] is not None:
            low[r] = min(low.get(r, 10**9), data[i][0])
    want = sorted(((d[0] is None, d[0] or 0, links[i], low[find[i]] if i in find else d[0]) for i, d in enumerate(data)), key=str)
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(df, recall=0.99999).collect()), key=str)
    assert got == want
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("n", [2, 1000, 10**6, 10**10])
def test_embedding_tables_reach_recall(n):
    bits, tables = embed_dedup.tables_for(n, 0.95, 0.995)
    p = (1 - math.acos(0.95) / math.pi) ** bits
    assert 1 - (1 - p) ** tables >= 0.995
