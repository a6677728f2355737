"""Logistic regression from scratch on the counts of a word list.

The list is the 193 words that most documents hold (punctuation removed, case kept, ties by
word), written as one JSON array and read back as a lookup table. The models: labelled
documents of the training split, y = +1 for quality 1; one plain ascent of 301 iterations and
six penalties of 501 iterations each, which all advance in the same passes.

Fixed values: list length 193; iterations 301 and 501; penalties 0 4 10 1e2 1e3 1e5; step
min(5e-6, 1e-3 / rows), a fiftieth of it for the plain ascent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.functions.hashing import bucket, sql_hash32
from tessera.operators import logistic as LG
from tessera.operators import sparse_rows as SR
from tessera.operators import text_features as TF
from tessera.plans.sqlbits import word_counts_sql
from tessera.registry import query
from tessera.session import scratch_path, written
from tessera.sources.tables import Tables, read_word_list

LISTED, PLAIN, PATH = 193, 301, 501
PENALTIES = [0.0, 4.0, 10.0, 1e2, 1e3, 1e5]
STEP, STEP_ROWS = 5e-6, 1e-3
INTERCEPT = "(intercept)"

_PUNCT_SQL = "'[!-/:-@\\[-`{-~]'"


def cleaned_counts(spark, sf_dir) -> DataFrame:
    docs = Tables(spark, sf_dir).documents.select("doc_id", TX.strip_punctuation("text").alias("text"))
    return TF.word_counts(docs, "doc_id", lower=False)


def word_list(spark, counts: DataFrame) -> DataFrame:
    """(word, j): the list through a JSON file in the shared folder; j counts from 1 in word order."""
    top = (counts.groupBy("word").agg(F.count(F.lit(1)).alias("df")).orderBy(F.desc("df"), "word").limit(LISTED)
           .agg(F.to_json(F.sort_array(F.collect_list("word"))).alias("value")))      # 193 words, one array
    path = scratch_path(spark, "word-list")
    top.coalesce(1).write.text(path)
    words = sorted(r["word"] for r in read_word_list(spark, path).collect())
    return spark.createDataFrame([(w, j + 1) for j, w in enumerate(words)], "word string, j int")


_LIST_SQL = f"""c AS (SELECT doc_id, regexp_replace(text, {_PUNCT_SQL}, '', 'g') AS text FROM documents),
wc AS ({word_counts_sql('c', 'doc_id', lower=False)}),
top AS (SELECT word FROM wc GROUP BY word ORDER BY count(*) DESC, word LIMIT {LISTED}),
list AS (SELECT word, row_number() OVER (ORDER BY word) AS j FROM top)"""


@query("word_list_counts", rows=("S4", "T6", "F3", "F8"), oracle=f"""
WITH {_LIST_SQL},
f AS (SELECT d.doc_id, l.j, coalesce(wc.count, 0) AS n FROM documents d CROSS JOIN list l
      LEFT JOIN wc ON wc.doc_id = d.doc_id AND wc.word = l.word)
SELECT doc_id, sum(n)::BIGINT AS n_listed, count_if(n > 0)::BIGINT AS n_distinct,
       md5(string_agg(n::VARCHAR, ',' ORDER BY j)) AS counts_md5 FROM f GROUP BY doc_id
""")
def word_list_counts(spark, sf_dir):
    """Bag of words restricted to the JSON word list: how many listed words each document has,
    and the digest of its 193 counts in word order (zeros where absent)."""
    counts = written(cleaned_counts(spark, sf_dir), "counts")
    words = word_list(spark, counts)
    bags = (counts.join(F.broadcast(words), "word").groupBy("doc_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("j", "count"))).alias("m")))       # 193 entries at most
    n = F.transform(F.sequence(F.lit(1), F.lit(LISTED)), lambda j: F.coalesce(F.element_at("m", j), F.lit(0)))
    out = Tables(spark, sf_dir).documents.select("doc_id").join(bags, "doc_id", "left").withColumn("n", F.coalesce(n, F.array_repeat(F.lit(0).cast("bigint"), LISTED)))
    listed = words.count()
    n = F.slice("n", 1, listed) if listed < LISTED else F.col("n")
    return out.select("doc_id", F.aggregate(n, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_listed"),
                      F.size(F.filter(n, lambda x: x > 0)).cast("bigint").alias("n_distinct"),
                      F.md5(F.array_join(F.transform(n, lambda x: x.cast("string")), ",")).alias("counts_md5"))


def labelled_blocks(spark, sf_dir):
    """Packed rows of the labelled training documents: column 0 is the intercept, j the listed
    words; their number; the list."""
    t = Tables(spark, sf_dir)
    train = t.labels.where(bucket("doc_id", 1) < 800).select("doc_id", F.col("quality").cast("double").alias("extra"))
    words = word_list(spark, cleaned_counts(spark, sf_dir))
    docs = t.documents.join(train.select("doc_id"), "doc_id", "left_semi").select("doc_id", TX.strip_punctuation("text").alias("text"))
    bags = (TF.word_counts(docs, "doc_id", lower=False).join(F.broadcast(words), "word").groupBy("doc_id")
            .agg(F.sort_array(F.collect_list(F.struct("j", F.col("count").cast("double").alias("v")))).alias("e")))
    empty = F.array().cast("array<struct<j:int,v:double>>")
    rows = (train.join(docs.select("doc_id"), "doc_id").join(bags, "doc_id", "left").withColumn("e", F.coalesce("e", empty))
            .select(F.col("doc_id").alias("id"), F.concat(F.array(F.lit(0)), F.col("e.j")).alias("cols"),
                    F.concat(F.array(F.lit(1.0)), F.col("e.v")).alias("vals"), "extra"))
    rows = written(rows, "labelled")
    blocks = SR.pack(SR.dealt(rows))
    n = sum(r["n"] for r in blocks.select((F.length("ids") / 8).cast("bigint").alias("n")).groupBy().sum("n").withColumnRenamed("sum(n)", "n").collect() if r["n"])
    return blocks, n, [INTERCEPT] + [r["word"] for r in words.orderBy("j").collect()]


def models_for(n: int) -> list[tuple[float, float, int]]:
    step = min(STEP, STEP_ROWS / max(n, 1))
    return [(step / 50, 0.0, PLAIN)] + [(step, l2, PATH) for l2 in PENALTIES]


_FIT_SQL = f"""
WITH RECURSIVE {_LIST_SQL},
lb AS (SELECT doc_id, quality::DOUBLE AS ind FROM labels SEMI JOIN documents USING (doc_id)
       WHERE {sql_hash32('doc_id', 1)} % 1000 < 800),
st AS (SELECT least({STEP}, {STEP_ROWS} / count(*)) AS step FROM lb),
models AS (SELECT 0 AS m, step / 50 AS step, 0.0::DOUBLE AS l2, {PLAIN} AS n FROM st
  UNION ALL SELECT i, step, l[i], {PATH} FROM st, (SELECT {PENALTIES}::DOUBLE[] AS l), unnest(range(1, {len(PENALTIES) + 1})) AS u(i)),
x AS MATERIALIZED (SELECT doc_id, ind, j, v FROM lb JOIN (
  SELECT doc_id, 0 AS j, 1.0::DOUBLE AS v FROM lb
  UNION ALL SELECT doc_id, j, count::DOUBLE FROM wc JOIN list USING (word)
  UNION ALL SELECT (SELECT min(doc_id) FROM lb), j, 0.0 FROM list) USING (doc_id)),
it(k, m, j, w) AS (
  SELECT 0, m, j, 0.0::DOUBLE FROM models, (SELECT 0 AS j UNION ALL SELECT j FROM list)
  UNION ALL
  SELECT any_value(g.k) + 1, g.m, g.j, any_value(it.w) + any_value(step) * (any_value(g.g) - CASE WHEN g.j > 0 THEN 2 * any_value(l2) * any_value(it.w) ELSE 0 END)
  FROM (SELECT s.k, s.m, x.j, sum((x.ind - 1 / (1 + exp(-s.s))) * x.v) AS g
        FROM (SELECT it.k, it.m, x.doc_id, sum(it.w * x.v) AS s FROM it JOIN x USING (j) JOIN models USING (m) WHERE it.k < models.n GROUP BY ALL) s
        JOIN x USING (doc_id) GROUP BY ALL) g
  JOIN it ON it.m = g.m AND it.j = g.j JOIN models ON models.m = g.m GROUP BY g.m, g.j),
fin AS (SELECT it.m, j, w, l2, n FROM it JOIN models USING (m) WHERE k = n),
ll AS (SELECT m, sum((ind - 1) * s - CASE WHEN s < -30 THEN -s ELSE ln(1 + exp(-s)) END) AS ll
  FROM (SELECT m, doc_id, any_value(ind) AS ind, sum(w * v) AS s FROM fin JOIN x USING (j) GROUP BY ALL) GROUP BY m),
pen AS (SELECT m, sum(CASE WHEN j > 0 THEN l2 * w * w ELSE 0 END) AS p FROM fin GROUP BY m)
SELECT fin.l2, fin.n::BIGINT AS iterations, coalesce(word, '{INTERCEPT}') AS word, round(w, 6) AS coefficient,
  CASE WHEN fin.j > 0 THEN row_number() OVER (PARTITION BY fin.m, fin.j > 0 ORDER BY round(w, 9) DESC, word) END AS rank,
  round(ll - p, 4) AS loglik
FROM fin LEFT JOIN list USING (j) JOIN ll USING (m) JOIN pen USING (m)
"""


@query("logistic_words", rows=("C6", "C7", "C8", "C9", "C10", "C11", "C14"), oracle=_FIT_SQL)
def logistic_words(spark, sf_dir):
    """Plain ascent and the coefficient path over six L2 penalties on 193 word columns and the
    intercept: every coefficient, its rank (the first and last five are the most positive and
    negative words), and the penalised log likelihood of its model."""
    blocks, n, words = labelled_blocks(spark, sf_dir)
    models = models_for(n)
    w, loglik = LG.sparse_ascent(blocks, len(words), models)
    blocks.unpersist()
    rows = []
    for m, (_, l2, iterations) in enumerate(models):
        order = sorted(range(1, len(words)), key=lambda j: (-round(float(w[j, m]), 9), words[j]))
        rank = {j: r + 1 for r, j in enumerate(order)}
        rows += [(l2, iterations, words[j], round(float(w[j, m]), 6), rank.get(j), round(float(loglik[m]), 4)) for j in range(len(words))]
    return spark.createDataFrame(rows, "l2 double, iterations bigint, word string, coefficient double, rank bigint, loglik double")
