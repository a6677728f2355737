"""Queries of the corpus operators: thin wrappers that derive the contract's columns.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds DuckDB SQL
where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, embed_dedup, jaccard_join, language_id, license_scan, lm_score, periodic_runs, quality, segment_search, suffix_dedup, token_alignment, url_filter
from tessera.llm.url_filter import Rule
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


# ------------------------------------------------------------------ 1: URL filter

URL_RULES = [Rule("allow", "com"), Rule("block", "example.com", "/en/"),
             Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
             Rule("block", "net", "/fr/")]

_OP1_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail
  FROM p),
t AS (
  SELECT host || tail AS src, host, path, replace(unnest([
      regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
      regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*["'']?([^"''\s>]+)', 1)]), '&amp;', '&') AS h
  FROM q),
a AS (
  SELECT src, CASE WHEN contains(h, '://') THEN substr(h, strpos(h, '://') + 3)
    WHEN starts_with(h, '//') THEN substr(h, 3) WHEN starts_with(h, '/') THEN host || h
    WHEN starts_with(h, '?') THEN host || path || h
    ELSE host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || h END AS x
  FROM t WHERE h <> '' AND NOT starts_with(h, '#')),
e AS (
  SELECT DISTINCT src, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(x, '^[^/?#]*([^#]*)', 1) AS dst
  FROM a),
pairs AS (SELECT src, dst FROM e WHERE src <> '' AND dst <> '' UNION SELECT dst, src FROM e WHERE src <> '' AND dst <> ''),
reach AS (SELECT src AS node, dst AS other FROM pairs UNION SELECT r.node, b.dst FROM reach r JOIN pairs b ON r.other = b.src),
judged AS (
  SELECT DISTINCT other, regexp_extract(other, '^[^/?]*') AS host, regexp_extract(other, '^[^/?]*([^?]*)', 1) AS path FROM reach),
rules(act, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
jr AS (
  SELECT other, arg_max(act, length(rh || rp)) AS act FROM judged, rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY other),
al AS (
  SELECT node, bool_or(act = 'allow') AS a, bool_or(act = 'block') AS b FROM reach LEFT JOIN jr USING (other) GROUP BY node),
own AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(act, length(rh || rp)) AS act FROM q, rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT q.page_id, q.host, q.path, own.rule,
  coalesce(own.act, CASE WHEN coalesce(al.b, false) AND NOT coalesce(al.a, false) THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN own.act IS NOT NULL THEN 'rule' WHEN coalesce(al.b, false) AND NOT coalesce(al.a, false) THEN 'alias' ELSE 'default' END AS reason
FROM q LEFT JOIN own USING (page_id) LEFT JOIN al ON al.node = q.host || q.tail
"""


@_query("op1_url_filter", _OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


# ------------------------------------------------------------------ 2: suffix-array dedup

_OP2_SQL = r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM b)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
f AS (SELECT w.doc_id, w.p FROM w JOIN m USING (s) WHERE first < w.doc_id),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM f),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g),
sp AS (SELECT doc_id, min(p) AS lo, max(p) + 50 AS hi FROM i GROUP BY doc_id, k),
t AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS hi FROM sp GROUP BY doc_id),
seg AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS z FROM sp
  UNION ALL SELECT doc_id, hi, n FROM t JOIN b USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS k FROM seg JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, b.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM b LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query("op2_suffix_array_dedup", _OP2_SQL)
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 3: language model

@_query("op3_lm_score")
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learns = quality.fold(F.col("doc_id"), 10) != 0
    out = lm_score.score(docs, learns, bpe.share(docs, vocabulary_path()))
    return out.select("doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


# ------------------------------------------------------------------ 4: licence scan

def _op4_sql() -> str:
    def values(rows) -> str:
        return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x).lower() for x in r) + ")" for r in rows)
    templates = license_scan.TEMPLATES
    index = values([(i, w, q, t.key_at <= q < t.key_at + len(t.key_words))
                    for i, t in enumerate(templates) for q, w in enumerate(t.words)])
    about = values([(i, t.label, t.base, len(t.key_words), t.key_at) for i, t in enumerate(templates)])
    return rf"""
WITH idx(t, word, place, is_key) AS (VALUES {index}),
about(t, label, base, key_size, key_at) AS (VALUES {about}),
d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
h AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d)
  WHERE word IN (SELECT word FROM idx)),
weights AS (
  SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) + 1e-9 AS weight
  FROM (SELECT DISTINCT word FROM idx) LEFT JOIN h USING (word) GROUP BY word),
totals AS (SELECT t, sum(weight) AS total FROM idx JOIN weights USING (word) GROUP BY t),
m AS (
  SELECT doc_id, label, base, off + key_at AS start, least(1.0, round(weight / total, 6)) AS score
  FROM (SELECT doc_id, t, pos - place AS off, sum(weight) AS weight, sum(CAST(is_key AS INTEGER)) AS keys
        FROM h JOIN idx USING (word) JOIN weights USING (word) GROUP BY ALL)
    JOIN about USING (t) JOIN totals USING (t)
  WHERE keys = key_size),
f AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN f USING (doc_id)
"""


@_query("op4_license_scan", _op4_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.label_files(table(spark, sf_dir, "documents"))
    return out.withColumn("base_labels", F.array_join("base_labels", ",")).withColumn("labels", F.array_join("labels", ","))


# ------------------------------------------------------------------ 5: Jaccard join

@_query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents")).drop("digest")


# ------------------------------------------------------------------ 6: language

@_query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.fold(F.col("doc_id"), 4) == 2
    found = language_id.predict(docs, language_id.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 7: embeddings

@_query("op7_embedding_near_dedup")
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


# ------------------------------------------------------------------ 8: byte-level BPE

def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = bpe.share(docs, vocabulary_path())
    out = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


# ------------------------------------------------------------------ 9: decontamination

_OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, bw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query("op9_benchmark_decontamination", _OP9_SQL)
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("bigint")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


# ------------------------------------------------------------------ 10: quality

def quality_model(docs: DataFrame, labels: DataFrame) -> quality.AdditiveModel:
    """Learned from the labels outside the held-out fifth."""
    return quality.fit(docs, labels.where(quality.fold(F.col("doc_id"), 5) != 0))


@_query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (quality.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= quality.SCORE_BOUND).cast("int").alias("predicted"))


# ------------------------------------------------------------------ 11: periodic runs

def _looped(docs: DataFrame) -> DataFrame:
    """doc_id, text: the text of every tenth document (by crc32 of its id) repeats a stretch of
    its own words from some word on, as the contract sets it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    d = docs.select("doc_id", "text", words.alias("_w"), F.floor(h / 10).alias("_g")).withColumn("_n", F.size("_w"))
    d = d.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    d = d.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    a, p = F.col("_a"), F.col("_p")
    again = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_w", F.when(i < a, i).otherwise(a + (i - a) % p)))
    return d.select("doc_id", F.when(F.col("_n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


_OP11_SQL = r"""
WITH c AS (
  SELECT doc_id, coalesce(text, '') AS text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE (x >> 1) END))) AS h
  FROM documents),
w0 AS (SELECT doc_id, h, h // 10 AS g, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM c),
w1 AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) ELSE 0 END AS a FROM w0),
w2 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w1),
w3 AS (SELECT doc_id, n, unnest(range(n)) AS i, w, h, a, p FROM w2),
t AS (SELECT doc_id, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM w3),
eq AS (SELECT y.doc_id, y.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= y.n),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM eq),
st AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM isl GROUP BY doc_id, q, k),
r AS (SELECT doc_id, start, length, min(q) AS period FROM st WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM t ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
best AS (
  SELECT x.doc_id, x.start, x.length, x.period FROM r x
  WHERE NOT EXISTS (FROM r y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
    OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period))))),
s AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query("op11_periodic_runs", _OP11_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_looped(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", periodic_runs.strongest())
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# ------------------------------------------------------------------ 12: token alignment

@_query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = vocabulary_path("piece_bpe_32k.model")
    tokenizers = token_alignment.share(spark, vocabulary_path("byte_bpe_50k.json"), b)
    out = token_alignment.align(table(spark, sf_dir, "documents"), tokenizers, token_alignment.vocabulary_size(b))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


# ------------------------------------------------------------------ 13: exact top-k search

_OP13_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@_query("op13_exact_topk", _OP13_SQL)
def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
